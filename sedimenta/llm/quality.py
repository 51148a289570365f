"""Quality rules and an isolation forest on their statistics.

The base rules reject short and self-repeating texts. The forest judges the rest: trees of random splits are grown on statistics of a bounded sample of
labelled rows, and a text that few splits isolate is an anomaly. Where the path length is too short is calibrated on the labels of the same sample: a
text is rejected only beyond what labelled good texts reach. Fitting is a driver matter of at most `SAMPLE` short vectors; scoring is one pass over the
texts without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import OUT_ROWS, text_or_empty

#: Labelled rows that the forest and its threshold are fitted on, at most: those whose id has the smallest hashes.
SAMPLE = 4000
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
ENDS = b".!?,;:"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeated", "distinct", "upper", "ends"]


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Positions covered by windows of so many words (a power of two) that occur twice or more. Exact: equal numbers stand for equal windows, and windows of
    twice the length are pairs of those."""
    n, size = len(ids), 1
    if n <= window:
        return 0
    while size < window:
        pairs = ids[: len(ids) - size] * np.int64(len(ids) + 1) + ids[size:]
        kinds, ids = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(pairs):
            return 0
        size *= 2
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts of a text and the forest's features. Words are runs of other than ASCII white space; null has none."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    symbols, dups = len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines))
    chars = len(text) - len(data) + sum(map(len, words))
    number: dict[bytes, int] = {}
    repeats = repeated_words(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)) if n > WINDOW else 0
    share = lambda x, of: x / of if of else 0.0
    removed = lambda some: len(data) - len(data.translate(None, some))
    features = [share(chars, n), share(symbols, chars), share(dups, len(lines)), share(repeats, n), share(len(number), n) if n > WINDOW else 1.0, share(removed(UPPER), chars), share(removed(ENDS), n)]
    return [n, chars, symbols, dups, repeats], features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])


def _harmonic_depth(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n leaves."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest(NamedTuple):
    """Trees as flat arrays of the same length: node k of a tree has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # -1: leaf
    cut: np.ndarray
    length: np.ndarray  # path length that ends here
    norm: float

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = 128, sample: int = 256, seed: int = 11) -> Forest:
        rng = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(2, sample)))))
        size = 2 ** (depth + 1) - 1
        feature, cut, length = np.full((trees, size), -1, np.int16), np.zeros((trees, size)), np.zeros((trees, size))
        for t in range(trees):
            todo = [(0, rows[rng.choice(len(rows), sample, replace=False)], 0)]
            while todo:
                k, own, d = todo.pop()
                low, high = own.min(axis=0), own.max(axis=0)
                can = np.flatnonzero(high > low)
                if d >= depth or len(own) <= 1 or not len(can):
                    length[t, k] = d + float(_harmonic_depth(len(own)))
                    continue
                f = int(rng.choice(can))
                feature[t, k], cut[t, k] = f, rng.uniform(low[f], high[f])
                left = own[:, f] <= cut[t, k]
                todo += [(2 * k + 1, own[left], d + 1), (2 * k + 2, own[~left], d + 1)]
        return cls(feature, cut, length, float(_harmonic_depth(sample)) or 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: 2 to the minus mean path length over its expectation."""
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for f, c, length in zip(self.feature, self.cut, self.length, strict=True):
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = f[at] >= 0
                if not inner.any():
                    break
                at = np.where(inner, 2 * at + 1 + (rows[each, np.maximum(f[at], 0)] > c[at]), at)
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / self.norm)


class Model(NamedTuple):
    forest: Forest
    low: np.ndarray
    high: np.ndarray
    threshold: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Features are clipped a little outside what good texts show: a wild value counts as outside, not as infinitely far."""
        return self.forest.score(np.clip(features, self.low, self.high))


#: What keeping a good row weighs against rejecting a bad one when the threshold is calibrated.
GOOD_WEIGHT = 20.0


def fit(features: np.ndarray, good: np.ndarray, seed: int = 11, trees: int = 128, sample: int = 256) -> Model:
    """The forest grows on the good rows and a quarter as many again that have one feature moved to anywhere in or somewhat beyond its good range:
    so splits fall outside the good range too, also of features that are constant in it.

    The threshold is the score with the best weighted accuracy on the labels, the higher of equals; where the labels have one kind only, the highest
    score of a good row (or of any row)."""
    rows = features[good] if good.any() else features
    low, high = np.quantile(rows, 0.001, axis=0), np.quantile(rows, 0.999, axis=0)
    width = np.maximum(high - low, 0.02)
    rng = np.random.default_rng(seed)
    moved = rows[rng.integers(0, len(rows), max(8, len(rows) // 4))].copy()
    which = rng.integers(0, features.shape[1], len(moved))
    moved[np.arange(len(moved)), which] = rng.uniform((low - width)[which], (high + width)[which])
    model = Model(Forest.grow(np.clip(np.vstack([rows, moved]), low - width, high + width), trees, sample, seed), low - width, high + width, 1.0)
    own = model.scores(features)
    if not good.any() or good.all():
        return model._replace(threshold=float(own.max()))
    g, b, cuts = np.sort(own[good]), np.sort(own[~good]), np.unique(own)
    gain = GOOD_WEIGHT * np.searchsorted(g, cuts, "right") / len(g) - np.searchsorted(b, cuts, "right") / len(b)
    k = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return model._replace(threshold=float((cuts[k] + cuts[min(k + 1, len(cuts) - 1)]) / 2))


def _measured(df: DataFrame, id_col: str, text_col: str, model: Model | None = None) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    more = [T.StructField("base_failed", T.BooleanType()), *([T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())] if model else [T.StructField("features", T.ArrayType(T.DoubleType()))])]
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *(T.StructField(x, T.LongType()) for x in COUNTS), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, OUT_ROWS) for k in range(0, whole.num_rows, OUT_ROWS)):
                both = [statistics(t) for t in b.column(1).to_pylist()]
                counts, features = np.array([x[0] for x in both], np.int64), np.array([x[1] for x in both])
                failed = base_failed(counts)
                if model:
                    score = model.scores(features)
                    rest = [pa.array(score), pa.array(~failed & ~(score > model.threshold))]
                else:
                    rest = [pa.array(features.tolist(), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(c)) for c in counts.T), pa.array(failed), *rest], schema.names)

    return rows.mapInArrow(run, schema)


def fit_on_labels(df: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", seed: int = 11) -> Model | None:
    """The model from labelled rows (label 1: good, other: bad, null: not labelled; a document with several labels counts as bad if one says so), at
    most `most` of them, taken by the hash of the id. Texts that fail the base rules take no part. None if nothing is left."""
    kinds = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.min(label_col) >= 1).alias("good"))
    taken = {r["id"]: r["good"] for r in kinds.orderBy(F.xxhash64("id"), "id").limit(most).collect()}
    if not taken:
        return None
    ids = F.broadcast(df.sparkSession.createDataFrame([(i,) for i in taken], T.StructType([T.StructField(id_col, df.schema[id_col].dataType)])))  # `most` ids
    rows = _measured(df.join(ids, id_col, "left_semi"), id_col, text_col).where("not base_failed").groupBy(id_col).agg(F.min("features").alias("features")).collect()
    if len(rows) < 2:
        return None
    rows = sorted(rows, key=lambda r: r[id_col])
    return fit(np.array([r["features"] for r in rows]), np.array([taken[r[id_col]] for r in rows]), seed)


def judge(df: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row for each row of df: the id, the base counts, base_failed, score (the forest's anomaly, 0 to 1; null without a model) and kept.

    A null or empty text has no words and fails the base rules. Repeated rows and null ids are judged each by its text. Without usable labels the base
    rules alone decide. An empty table gives an empty result. Other columns are not read."""
    model = fit_on_labels(df, labels, most, id_col, text_col, label_col)
    if model is None:
        return _measured(df, id_col, text_col).select(id_col, *COUNTS, "base_failed", F.lit(None).cast("double").alias("score"), (~F.col("base_failed")).alias("kept"))
    return _measured(df, id_col, text_col, model)


def keep(df: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of df that `judge` keeps, with all their columns, in one pass."""
    model, at = fit_on_labels(df, labels, most, id_col, text_col, label_col), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, OUT_ROWS) for k in range(0, whole.num_rows, OUT_ROWS)):
                both = [statistics(t) for t in b.column(at).to_pylist()]
                kept = ~base_failed(np.array([x[0] for x in both], np.int64))
                if model:
                    kept &= ~(model.scores(np.array([x[1] for x in both])) > model.threshold)
                yield b.filter(pa.array(kept))

    return df.mapInArrow(run, df.schema)
