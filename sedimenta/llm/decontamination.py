"""Benchmark decontamination with an FM-index of each training shard.

A task gathers documents into shards of bounded size and builds for each shard a suffix array over its words, the Burrows-Wheeler transform, a wavelet
matrix with ranks, and sampled suffix positions. All phrases of the benchmark are then searched backwards together; occurrences are located by walking to
the next sample, and their spans merge into what has to be removed. Words that no phrase has end a segment: no occurrence reaches over them, so they
stand in the index as terminators, and segments shorter than the shortest phrase are left out of it. The corpus is read once and never shuffled."""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import text_or_empty

WINDOW = 10
#: Words of one shard's index, and words of the documents that a task holds at once.
SHARD_WORDS = 1_000_000
#: Every so manieth suffix position is stored.
SAMPLED = 8
#: Benchmark bytes of one block, some 20 MB as arrays of windows; a worker unpacks one block at a time. More than MOST_BYTES in all is refused.
BLOCK_BYTES = 2 * 2**20
MOST_BYTES = 64 * 2**20
#: Lower case for A-Z, a space for ASCII that is no letter or digit; bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Of a sequence where 0 ends a segment: ends compare by their place, each smaller than any word, so no comparison goes past one. Prefix doubling, each
    round on the suffixes that are not yet told apart."""
    n = len(symbols)
    first = np.where(symbols == 0, np.cumsum(symbols == 0) - 1, symbols.astype(np.int64) + n)
    order = np.argsort(first, kind="stable")
    ranked = first[order]
    head = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = start, 0
    alone = head & np.concatenate([head[1:], [True]])
    todo, k = order[~alone], 1
    while len(todo):
        old = rank[todo]
        key = old * (n + 1) + rank[np.minimum(todo + k, n)]
        by = np.argsort(key, kind="stable")
        todo, key, old = todo[by], key[by], old[by]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], old[1:] != old[:-1]])
        at = np.arange(len(todo))
        start = np.maximum.accumulate(np.where(head, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank[todo] = old + start
        alone = head & np.concatenate([head[1:], [True]])
        todo, k = todo[~alone], 2 * k
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


class FMIndex:
    """Over symbols 0..sigma; 0 ends a segment and must stand last."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        sa = suffix_array(symbols)
        self.n, before = len(symbols), symbols[sa - 1]  # the suffix at 0 gets the last symbol, an end
        self.last = before
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))])
        # Wavelet matrix: one level for each bit, from the highest; ones counted before each place.
        self.ones, self.zeros, row = [], [], before
        for b in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            bits = (row >> b & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bits, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(self.n - int(self.ones[-1][-1]))
            row = np.concatenate([row[~bits], row[bits]])
        self.starts = self._descend(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))
        # Suffix positions at every SAMPLED-th place and at the start of a segment, where a walk has to end.
        kept = (sa % SAMPLED == 0) | (before == 0)
        self.kept, self.samples, self.index = kept, sa[kept], np.cumsum(kept) - 1

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        b = len(self.ones) - 1
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            i = np.where(c >> b & 1, zeros + ones[i], i - ones[i])
            b -= 1
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before place i of the transform."""
        return self._descend(c, i) - self.starts[c]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with each phrase (rows of symbols, aligned to the right)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = phrases[live, phrases.shape[1] - 1 - step]
            lo[live], hi[live] = self.below[c] + self.rank(c, lo[live]), self.below[c] + self.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the sequence of each row of the suffix array."""
        out, at, steps, todo = np.empty(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(todo):
            known = self.kept[at]
            out[todo[known]] = self.samples[self.index[at[known]]] + steps
            todo, at = todo[~known], at[~known]
            c = self.last[at]
            at, steps = self.below[c] + self.rank(c, at), steps + 1
        return out


class Phrases(NamedTuple):
    """One block of the benchmark, ready to search."""

    words: dict[bytes, int]
    rows: np.ndarray  # distinct windows, aligned to the right
    lengths: np.ndarray
    first: np.ndarray  # window k is of the items first[k] .. first[k + 1]
    items: np.ndarray  # indices into names
    names: list[str]

    def packed(self) -> bytes:
        return zlib.compress(pickle.dumps((b"\n".join(self.words), self.rows.astype(np.int32), self.lengths.astype(np.int16), self.first, self.items, self.names), 5), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Phrases:
        words, rows, lengths, first, items, names = pickle.loads(zlib.decompress(data))
        return cls({w: k + 1 for k, w in enumerate(words.split(b"\n"))} if words else {}, rows, lengths, first, items, names)


def phrases(items: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    """Windows of `window` consecutive words; an item of fewer words is one window, an item without words none."""
    words: dict[bytes, int] = {}
    names = sorted({str(i) for i, _ in items if i is not None})
    number = {x: k for k, x in enumerate(names)}
    rows, lengths, owners = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for i, text in items:
        ids = np.array([words.setdefault(w, len(words) + 1) for w in words_of(text)], np.int32)
        if not len(ids):
            continue
        some = np.lib.stride_tricks.sliding_window_view(ids, window) if len(ids) >= window else np.concatenate([np.zeros(window - len(ids), np.int32), ids])[None]
        rows.append(some)
        lengths.append(np.full(len(some), min(window, len(ids)), np.int32))
        owners.append(np.full(len(some), -1 if i is None else number[str(i)], np.int32))
    rows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    which, owners, sizes = which.ravel(), np.concatenate(owners), np.zeros(len(rows), np.int64)
    sizes[which] = np.concatenate(lengths)
    pairs = np.unique(which[owners >= 0] * np.int64(len(names) + 1) + owners[owners >= 0])
    of, own = np.divmod(pairs, len(names) + 1)
    return Phrases(words, rows, sizes, np.searchsorted(of, np.arange(len(rows) + 1)), own, names)


def shards(docs: list[list[bytes]], known: dict[bytes, int], shortest: int, longest: int, size: int = SHARD_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbols, document, word position) of each shard. Documents longer than a shard go on in the next, with `longest` - 1 words twice."""
    parts: list[tuple[np.ndarray, ...]] = []
    total = 0
    for d, words in enumerate(docs):
        for lo in range(0, len(words), size):
            own = words[lo : lo + size + longest - 1] if len(words) > size else words
            symbols = np.fromiter(map(known.get, own, itertools.repeat(0)), np.int32, len(own))
            inside = np.concatenate([[False], symbols > 0, [False]])
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            begin, end = edges[::2], edges[1::2]
            long = end - begin >= shortest
            begin, end = begin[long], end[long]
            if not len(begin):
                continue
            sizes = end - begin + 1  # with the end of the segment
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
            some = np.append(symbols, 0)[at]
            some[np.cumsum(sizes) - 1] = 0
            parts.append((some, np.full(len(at), d), at + lo))
            total += len(at)
            if total >= size:
                yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                parts, total = [], 0
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def occurrences(docs: list[list[bytes]], block: Phrases, size: int = SHARD_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, first word, window) of every occurrence, a shard at a time."""
    if not len(block.rows):
        return
    shortest, longest = int(block.lengths.min()), int(block.lengths.max())
    for symbols, doc, place in shards(docs, block.words, shortest, longest, size):
        index = FMIndex(symbols.astype(np.int64), len(block.words))
        lo, hi = index.search(block.rows, block.lengths)
        n = hi - lo
        window = np.repeat(np.arange(len(n)), n)
        rows = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        at = index.locate(rows)
        yield doc[at], place[at], window


def _judged(docs: list[list[bytes]], blocks: Callable[[], Iterator[Phrases]], size: int) -> list[tuple[int, int, list[tuple[int, int]], list[str]]]:
    """Of each document: words, words hit, merged spans, names of the items."""
    sizes = np.array([len(d) for d in docs], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    edge, items = np.zeros(int(base[-1]) + 1, np.int64), [set() for _ in docs]
    for block in blocks():
        for doc, place, window in occurrences(docs, block, size):
            np.add.at(edge, base[doc] + place, 1)
            np.add.at(edge, base[doc] + place + block.lengths[window], -1)
            for pair in np.unique(doc * len(block.rows) + window).tolist():
                d, w = divmod(pair, len(block.rows))
                items[d].update(block.names[k] for k in block.items[block.first[w] : block.first[w + 1]].tolist())
    hit = np.cumsum(edge) > 0
    out = []
    for d in range(len(docs)):
        own = hit[base[d] : base[d] + sizes[d]]
        n = int(own.sum())
        spans = []
        if n:
            turns = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            spans = list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))
        out.append((int(sizes[d]), n, spans, sorted(items[d])))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these spans of words, and what stands between the words of a span; a line break takes the place."""
    if not spans:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "\n".join(x for x in [*out, text[at:]] if x.strip())


def blocks_of(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> list[Broadcast]:
    """Broadcasts of the benchmark, packed, block by block. Its size is checked first; it is a set of test items, not a corpus. The driver holds one block."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_col).alias("item"), text_or_empty(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    if total > MOST_BYTES:
        raise ValueError(f"the benchmark has {total} bytes, more than {MOST_BYTES}; give it in parts")
    out, some, size = [], [], 0
    for r in rows.toLocalIterator():
        some.append((r["item"], r["text"]))
        size += len(r["text"].encode()) + 64
        if size >= BLOCK_BYTES:
            out.append(spark.sparkContext.broadcast(phrases(some, window).packed()))
            some, size = [], 0
    if some:
        out.append(spark.sparkContext.broadcast(phrases(some, window).packed()))
    return out


def reader(sent: list[Broadcast]) -> Callable[[], Iterator[Phrases]]:
    """The blocks in turn, one unpacked at a time; a single one stays."""
    if len(sent) == 1:
        only = Phrases.unpacked(sent[0].value)
        return lambda: iter((only,))
    return lambda: (Phrases.unpacked(x.value) for x in sent)


RESULT = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType()), ("spans", T.ArrayType(T.ArrayType(T.LongType())))]


def contamination(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = SHARD_WORDS) -> DataFrame:
    """One row for each row of df: the id, n_words, n_hit (words inside an occurrence of a benchmark window), n_items and items_sha256 (of the item ids as
    sorted strings with commas between), contaminated (n_hit > 0), and spans, the merged [first word, end) ranges to remove.

    A null or empty text has no words and is clean; null or empty items have no windows; an item with a null id makes hits but is not named. Items that
    repeat count once by their id. An empty benchmark finds nothing. Rows with null or repeated ids are judged each. Other columns are not read."""
    blocks = blocks_of(benchmark, window, item_col, item_text_col)
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *(T.StructField(*x) for x in RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, judged in _groups(batches, 0, 1, reader(blocks), size):
            yield pa.RecordBatch.from_arrays([ids, *_columns(judged)], schema.names)

    return rows.mapInArrow(run, schema)


def _columns(judged: list) -> list[pa.Array]:
    sums = [hashlib.sha256(",".join(x[3]).encode()).hexdigest() for x in judged]
    return [
        pa.array([x[0] for x in judged], pa.int64()), pa.array([x[1] for x in judged], pa.int64()), pa.array([len(x[3]) for x in judged], pa.int64()), pa.array(sums, pa.string()),
        pa.array([x[1] > 0 for x in judged], pa.bool_()), pa.array([[list(s) for s in x[2]] for x in judged], pa.list_(pa.list_(pa.int64()))),
    ]


def _groups(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int, blocks: Callable[[], Iterator[Phrases]], size: int) -> Iterator[tuple[pa.Array, pa.RecordBatch, list]]:
    """Rows of a batch, some at a time, so that their words stay within `size` (or are one document)."""
    for b in batches:
        docs, n, lo = [], 0, 0
        for k, text in enumerate(b.column(text_at).to_pylist()):
            docs.append(words_of(text))
            n += len(docs[-1])
            if n >= size or k == b.num_rows - 1:
                part = b.slice(lo, k + 1 - lo)
                yield part.column(id_at), part, _judged(docs, blocks, size)
                docs, n, lo = [], 0, k + 1


def decontaminate(df: DataFrame, benchmark: DataFrame, action: str = "drop", window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """df without contamination, all columns kept, in one pass. "drop" removes contaminated rows; "cut" removes the spans from their texts (again and again,
    should a cut join words to a new occurrence). Clean rows stay as they are, null texts too."""
    if action not in ("drop", "cut"):
        raise ValueError("action is drop or cut")
    blocks, at, schema = blocks_of(benchmark, window, item_col, item_text_col), df.columns.index(text_col), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = reader(blocks)
        for _, part, judged in _groups(batches, 0, at, block, SHARD_WORDS):
            if action == "drop":
                yield part.filter(pa.array([not x[1] for x in judged], pa.bool_()))
                continue
            texts = part.column(at).to_pylist()
            for k, x in enumerate(judged):
                while x[1]:
                    texts[k] = without(texts[k], x[2])
                    x = _judged([words_of(texts[k])], block, SHARD_WORDS)[0]
            columns = list(part.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return df.mapInArrow(run, schema)
