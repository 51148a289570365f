"""SimHash near-duplicates by Jaccard similarity of word shingles, for stages without a contract of their own.

A similarity of 0.8 is about ten differing bits of 64 on average and over twenty at worst, more than any affordable choice of pigeonhole blocks covers. So
bands of MinHash values choose the buckets here; inside a bucket the SimHash fingerprints of the shingle sets are compared in bit slices, and the sets
decide about the pairs within the radius, unless these are linked already. Equal sets collapse first; buckets of the same members are compared
once. A bucket of more shingles than a task should hold is dealt in blocks, each with the bucket's first member, which ties them together; whatever that
doesn't reach is then compared with all of the bucket, block by block. Only links that join two groups leave a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import OUT_ROWS, bucketed, stored, text_or_empty
from sedimenta.llm.components import components
from sedimenta.llm.simhash import KEY, keep_one, near_pairs, same_id

BANDS, ROWS = 18, 5
_RANDOM = np.random.default_rng(42)
_TIMES, _PLUS = (_RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
#: Shingles that are hashed for all bands at once.
AT_ONCE = 4096
#: Differing bits above which two sets aren't looked at. Two of similarity 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 24
#: Shingles that a task holds at once.
MOST = 2_000_000


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles. A-Z is lower-cased; words are runs of other than ASCII white space; fewer than `words` words are one shingle."""
    found = (text or "").encode().lower().split()
    n = max(1, len(found) - words + 1) if found else 0
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(found[k : k + words])) for k in range(n)), np.uint64, n))


def bands(own: np.ndarray) -> np.ndarray:
    """The key of each band; none for an empty set, which only equals itself."""
    if not len(own):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for k in range(0, len(own), AT_ONCE):
        least = np.minimum(least, (own[k : k + AT_ONCE, None] * _TIMES + _PLUS).min(axis=0))
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), b) for b, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both) - 1e-9


def print_of(own: np.ndarray) -> int:
    """SimHash of a set of shingle hashes: each bit by majority."""
    if not len(own):
        return 0
    counts = sum(np.unpackbits(own[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for k in range(0, len(own), 65536))
    return int(np.packbits(2 * counts > len(own), bitorder="little").view(np.uint64)[0])


def _sketched(df: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, h: hash of id and text, s: hash of the shingle set, f: its SimHash, n: its size, bands)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(KEY).alias("h"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, words) for t in b.column(2).to_pylist()]
            s, f = (np.array([of(x) for x in sets], np.uint64).view(np.int64) for of in (lambda x: xxhash.xxh3_64_intdigest(x.tobytes()), print_of))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array(f), pa.array([len(x) for x in sets], pa.int64()), pa.array([bands(x) for x in sets], pa.list_(pa.int64()))], ["id", "h", "s", "f", "n", "bands"])

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), *(T.StructField(x, T.LongType()) for x in "hsfn"), T.StructField("bands", T.ArrayType(T.LongType()))]))


def _dealt(df: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """wanted (s, id, h, f, keys: (key, role)) -> (key, role, s, f, own: the shingle set), one row for each key."""
    wanted = stored(wanted.withColumnRenamed("id", "_id"), "wanted")
    texts = df.select(F.col(id_col).alias("id"), F.col(KEY).alias("_h"), text_or_empty(text_col).alias("text"))
    found = texts.join(wanted, (F.col("_h") == F.col("h")) & same_id("id", "_id")).select("s", "f", "keys.key", "keys.role", "text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, f, keys, roles, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = shingles(text, words).tobytes()
                for lo in range(0, len(keys), 64):
                    some = keys[lo : lo + 64]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(roles[lo : lo + 64], pa.int32()), *(pa.array([x] * len(some), t) for x, t in ((s, pa.int64()), (f, pa.int64()), (own, pa.binary())))], ["key", "role", "s", "f", "own"])

    return found.mapInArrow(deal, "key long, role int, s long, f long, own binary")


def _compared(rows: DataFrame, least: float) -> DataFrame:
    """(a, b): links between the members of a key with role 0, and from those to the members with role 1, enough to connect all similar ones."""

    def links(f: list[int], sets: list[np.ndarray], held: int) -> Iterator[tuple[int, int]]:
        label = np.arange(len(f))
        for i, j in near_pairs(np.array(f, np.int64).view(np.uint64), np.zeros(len(f), np.int64), RADIUS):
            some = (i < held) & (label[i] != label[j])
            for x, y in zip(i[some].tolist(), j[some].tolist(), strict=True):
                if label[x] != label[y] and similar(sets[x], sets[y], least):
                    label[label == label[y]] = label[x]
                    yield x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of key, role and set; a key's rows with role 0 are held, and as many more at a time."""
        now, held, s, f, sets, size, last = None, 0, [], [], [], 0, None

        def linked() -> Iterator[pa.RecordBatch]:
            made = [(s[x], s[y]) for x, y in links(f, sets, held)] if len(s) > 1 else []
            for k in range(0, len(made), OUT_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made[k : k + OUT_ROWS], strict=True)], ["a", "b"])

        for b in batches:
            for key, role, one, print_, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != now:
                    yield from linked()
                    now, held, s, f, sets, size, last = key, 0, [], [], [], 0, None
                if (role, one) == last:  # an id and its text can repeat
                    continue
                if role and size > MOST:
                    yield from linked()
                    s, f, sets, size = s[:held], f[:held], sets[:held], 0
                last = role, one
                own = np.frombuffer(own, np.uint64)
                s.append(one)
                f.append(print_)
                sets.append(own)
                if role:
                    size += len(own)
                else:
                    held += 1
        yield from linked()

    return rows.repartition("key").sortWithinPartitions("key", "role", "s").mapInArrow(run, "a long, b long")


def _links(df: DataFrame, docs: DataFrame, least: float, words: int, id_col: str, text_col: str, most: int = MOST) -> DataFrame:
    """(a, b): pairs of shingle sets, enough to connect all similar ones that share a bucket."""
    one = docs.groupBy("s").agg(F.min(F.struct(F.col("id").isNull(), "id", "h", "f", "n", "bands")).alias("x"))
    one = stored(one.select("s", "x.id", "x.h", "x.f", "x.n", "x.bands"), "sets")
    rows, one = one.select("s", "n", F.explode("bands").alias("bucket")), one.select("s", "id", "h", "f")
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("s").cast("decimal(38,0)")).alias("who"), F.sum("n").alias("w"), F.min("s").alias("hub")).where("c > 1")
    once = shared.groupBy("c", "who").agg(F.min(F.struct("bucket", "w", "hub")).alias("x"))
    once = stored(once.select("x.bucket", "x.w", "x.hub", F.ceil(F.col("x.w") / most).cast("int").alias("g")), "buckets")
    members = rows.join(once, "bucket")
    block = F.pmod(F.xxhash64("s", "bucket"), F.col("g")).cast("int")
    own = F.when(F.col("g") == 1, F.array("bucket")).when(F.col("s") == F.col("hub"), F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda k: F.xxhash64("bucket", k))).otherwise(F.array(F.xxhash64("bucket", block)))
    keys = members.select("s", F.explode(F.transform(own, lambda k: F.struct(k.alias("key"), F.lit(0).alias("role")))).alias("k"))
    wanted = keys.groupBy("s").agg(F.collect_list("k").alias("keys")).join(one, "s")
    links = stored(_compared(_dealt(df, wanted, words, id_col, text_col), least), "links")
    if not once.where("g > 1").take(1):
        return links
    # In large buckets: members that the first one doesn't reach, in blocks, against all members, in parts.
    reached = components(links).withColumnRenamed("id", "s")
    large = rows.join(once.where("g > 1"), "bucket").join(reached, "s", "left").withColumn("component", F.coalesce("component", "s"))
    of_hub = large.where(F.col("s") == F.col("hub")).select("bucket", F.col("component").alias("first"))
    large = stored(large.join(of_hub, "bucket").withColumn("rest", F.col("component") != F.col("first")), "large")
    left = large.where("rest").groupBy("bucket").agg(F.ceil(F.sum("n") / most).cast("int").alias("r"))
    large = large.join(left, "bucket")
    parts, part = F.ceil(F.col("w") / (16 * most)).cast("int"), lambda n: F.pmod(F.xxhash64("s", F.lit(1)), n).cast("int")
    key = lambda r, p, role: F.struct(F.xxhash64("bucket", r, p).alias("key"), F.lit(role).alias("role"))
    held = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: key(part(F.col("r")), p, 0))
    passing = F.transform(F.sequence(F.lit(0), F.col("r") - 1), lambda r: key(r, part(parts), 1))
    keys = large.select("s", F.explode(F.when(F.col("rest"), F.concat(held, passing)).otherwise(passing)).alias("k"))
    wanted = keys.groupBy("s").agg(F.collect_list("k").alias("keys")).join(one, "s")
    return links.union(stored(_compared(_dealt(df, wanted, words, id_col, text_col), least), "links"))


def one_of_each(df: DataFrame, least: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """One row of df for each component of texts whose shingle sets have a Jaccard similarity of `least` or more, the one with the smallest id, all
    columns kept; rows with a null id can't be named and stay, all of them. An id that repeats with different texts stays once for each component of
    which it is the smallest id; rows that repeat an id and its text are copies. Null, empty and blank texts are copies of each other. Ids have any type with an
    order. An empty table gives an empty result. `most`: shingles that a task holds at once."""
    df, names = bucketed(df.withColumn(KEY, F.xxhash64(F.col(id_col), text_or_empty(text_col))), KEY, "by_text"), df.columns  # the texts move this once
    docs = stored(_sketched(df, words, id_col, text_col), "sketches")
    found = components(stored(_links(df, docs, least, words, id_col, text_col, most), "links"))
    members = docs.select("id", "h", "s").join(found.select(F.col("id").alias("s"), "component"), "s", "left")
    return keep_one(df, members.select("id", "h", F.coalesce("component", "s").alias("component")), docs, id_col).select(*(F.col(f"`{c}`") for c in names))
