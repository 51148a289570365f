"""Near-duplicates by SimHash, compared in bit slices.

Fingerprints: XXH64 of every word shingle, the majority of each bit. Equal fingerprints collapse before anything is compared, so a group of exact copies
costs one row. Distinct fingerprints within `radius` bits agree wholly on some choice of `blocks - radius` out of `blocks` bit blocks; each choice is a
bucket key. Inside the buckets of a task the fingerprints stand as 64 bit planes; one pass compares every fingerprint with the one k places on, for all
places at once: the differing bits of a plane are added to bitwise counters (carry-save, saturating above the radius), and words whose pairs are all
over the radius are abandoned. A bucket that outgrows one task is split on further blocks of its remaining bits, by the same rule, so no pair is lost.
Only a spanning forest of the links leaves a task."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import OUT_ROWS, bucketed, stored, text_or_empty
from sedimenta.llm.components import components

BITS = 64
#: Shingle hashes whose bits are counted at once.
AT_ONCE = 200_000


def fingerprints(texts: list[str | None], words: int = 3, seed: int = 42) -> np.ndarray:
    """uint64 of each text. A-Z is lower-cased; words are runs of other than ASCII white space; a text with fewer than `words` words is one shingle, and
    one without words has the fingerprint zero. A bit is set if it is set in over half the shingles, repeats included."""
    out = np.zeros(len(texts), np.uint64)
    for k, text in enumerate(texts):
        found = (text or "").encode().lower().split()
        if not found:
            continue
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)) if len(found) > words else iter((b" ".join(found),))
        counts, n = np.zeros(BITS, np.int64), 0
        while some := list(itertools.islice(shingles, AT_ONCE)):
            bits = np.unpackbits(np.frombuffer(b"".join(map(xxhash.xxh64_digest, some, itertools.repeat(seed))), np.uint8).reshape(-1, 8)[:, ::-1], axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int32)
            n += len(some)
        out[k] = np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0]
    return out


def planes(values: np.ndarray) -> np.ndarray:
    """Vertical form: row b holds bit b of all values, 64 values to a word."""
    pad = -len(values) % 64
    bits = np.unpackbits(np.concatenate([values, np.zeros(pad, np.uint64)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


#: Words (of 64 pairs) of one block: small enough for the cache, large enough to pay for the call.
BLOCK = 512


def near_pairs(values: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of the same group that differ in at most `radius` bits. `group` is sorted; values of a group stand together.

    For k = 1, 2, ... all pairs (i, i + k) are compared together on the bit planes, until no group is longer than k."""
    n = len(values)
    if n < 2:
        return
    all_planes = planes(values)
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])))
    left = np.repeat(sizes, sizes) - 1 - (np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes))  # how many of the group follow
    levels = radius.bit_length()
    for k in range(1, int(sizes.max())):
        valid = np.zeros(all_planes.shape[1] * 64, bool)
        valid[:n] = left >= k
        dead = ~np.packbits(valid, bitorder="little").view(np.uint64)
        live = np.flatnonzero(dead != ~np.uint64(0))
        for lo in range(0, len(live), BLOCK):
            at = live[lo : lo + BLOCK]
            w, r = divmod(k, 64)
            over, counters = dead[at], [np.zeros(len(at), np.uint64) for _ in range(levels)]
            near, far = np.minimum(at + w, all_planes.shape[1] - 1), np.minimum(at + w + 1, all_planes.shape[1] - 1)
            for b in range(BITS):
                plane = all_planes[b]
                other = plane[near] if not r else (plane[near] >> np.uint64(r)) | (plane[far] << np.uint64(64 - r))
                carry = plane[at] ^ other
                for c in range(levels):
                    counters[c], carry = counters[c] ^ carry, counters[c] & carry
                over = over | carry
                if b % 8 == 7:  # a counter past its last bit has set `over` by its carry; between that and the radius it is seen here
                    over = over | _above(counters, radius) if levels else over
                if b % 8 == 7 and (keep := np.flatnonzero(over != ~np.uint64(0))).size < len(at):
                    if not keep.size:
                        at = at[:0]
                        break
                    at, over, near, far = at[keep], over[keep], near[keep], far[keep]
                    counters = [c[keep] for c in counters]
            if len(at):
                found = np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64)
                word, bit = np.nonzero(found)
                i = at[word] * 64 + bit
                yield i, i + k


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits whose counter exceeds the radius."""
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], ~np.uint64(0))
    for c in range(len(counters) - 1, -1, -1):
        if radius >> c & 1:
            same = same & counters[c]
        else:
            more, same = more | (same & counters[c]), same & ~counters[c]
    return more


def _blocks(mask: int, blocks: int) -> list[int]:
    """The set bits of a mask, cut into so many parts of nearly equal size."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    return [sum(1 << b for b in bits[len(bits) * k // blocks : len(bits) * (k + 1) // blocks]) for k in range(blocks)]


def key_masks(blocks: int, radius: int, free: int = 2**BITS - 1) -> list[int]:
    """Masks such that two values which differ in at most `radius` of the `free` bits agree on all of one mask."""
    parts = _blocks(free, blocks)
    return [sum(c) for c in itertools.combinations(parts, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >> 63 else mask


def _forest(i: np.ndarray, j: np.ndarray, root: dict[int, int]) -> Iterator[tuple[int, int]]:
    """The pairs that join two trees of the task's forest."""
    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            yield x, y


def near_links(prints: DataFrame, radius: int = 2, blocks: int = 4, most: int = 4_000) -> DataFrame:
    """prints (f: distinct fingerprints as long, id) -> links (a, b) of ids, enough to connect whatever is within the radius.

    `most`: fingerprints that one bucket may bring into a task; larger buckets are dealt again by more bits of theirs."""
    keys = [(k, _signed(m)) for k, m in enumerate(key_masks(blocks, radius))]
    rows = prints.select("f", "id", F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.col("f").bitwiseAND(F.lit(m)).alias("key"), F.lit(m).alias("mask")) for k, m in keys))).alias("x")).select("f", "id", F.xxhash64("x.t", "x.key").alias("bucket"), "x.mask")
    out, rows = None, stored(rows, "buckets") if radius else rows
    while True:
        large = rows.groupBy("bucket").count().where(F.col("count") > most).select("bucket")
        large = stored(large, "large")
        split = large.take(1)
        small = rows.join(large, "bucket", "left_anti") if split else rows
        links = _compared(small, radius)
        out = links if out is None else out.union(links)
        if not split:
            return out
        rows = stored(_split(rows.join(large, "bucket", "left_semi"), radius), "buckets")


def _split(rows: DataFrame, radius: int) -> DataFrame:
    """Every fingerprint of a large bucket to radius + 1 smaller ones: the bucket's bits and one more block of the others. Two within the radius differ in at
    most `radius` of the blocks, so they meet in one at least. Where all bits are in the key only equal values would meet, and those were collapsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[int]] = {}
        for b in batches:
            f, ids, bucket, mask = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for m in np.unique(mask).tolist():
                own = m & (2**BITS - 1)
                at = np.flatnonzero(mask == m)
                for k, p in enumerate(parts.setdefault(own, _blocks(2**BITS - 1 & ~own, radius + 1))):
                    if p:
                        key = _scramble(bucket[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _scramble((f[at].view(np.uint64) & np.uint64(p)) + np.uint64(k)))
                        yield pa.RecordBatch.from_arrays([pa.array(f[at]), pa.array(ids[at]), pa.array(key.view(np.int64)), pa.array(np.full(len(at), _signed(own | p)))], ["f", "id", "bucket", "mask"])

    return rows.select("f", "id", "bucket", "mask").mapInArrow(run, "f long, id long, bucket long, mask long")


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _compared(rows: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a partition come in order of their bucket; whole buckets are compared some at a time."""
        root: dict[int, int] = {}
        kept: list[tuple[np.ndarray, ...]] = []

        def compare(bucket: np.ndarray, f: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            pairs: list[tuple[int, int]] = []
            for i, j in near_pairs(f.view(np.uint64), bucket, radius):
                pairs += _forest(ids[i], ids[j], root)
            for k in range(0, len(pairs), OUT_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs[k : k + OUT_ROWS], strict=True)], ["a", "b"])

        for b in batches:
            kept.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
            if sum(len(x[0]) for x in kept) >= 50_000:
                bucket, f, ids = (np.concatenate(x) for x in zip(*kept, strict=True))
                whole = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                yield from compare(bucket[:whole], f[:whole], ids[:whole])
                kept = [(bucket[whole:], f[whole:], ids[whole:])]
                if len(root) > 1_000_000:
                    root.clear()
        if kept:
            yield from compare(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return rows.select("bucket", "f", "id").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def hashed(df: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, f): the fingerprint of each row as a signed long."""
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints(b.column(1).to_pylist(), words).view(np.int64))], ["id", "f"])

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("f", T.LongType())]))


def hex16(f: Column) -> Column:
    return F.lpad(F.lower(F.hex(f)), 16, "0")


def near_duplicates(df: DataFrame, radius: int = 2, words: int = 3, id_col: str = "doc_id", text_col: str = "text", blocks: int = 4, most: int = 4_000) -> DataFrame:
    """One row for each row of df: the id, fingerprint (16 hex digits) and component_id, the smallest id that links of at most `radius` bits reach.

    A null or empty text, or one without words, has the fingerprint zero and links like any other. Rows that repeat an id are each returned; they share a
    component only if their fingerprints link. Ids have any type with an order. A null id counts as no id: it takes the component of its fingerprint, null
    if that has none. An empty table gives an empty result. Other columns are not read."""
    docs = stored(hashed(df, words, id_col, text_col), "fingerprints")
    named = _members(docs, radius, blocks, most).select("f", "component_id")
    return docs.join(named, "f").select(F.col("id").alias(id_col), hex16(F.col("f")).alias("fingerprint"), "component_id")


def _members(docs: DataFrame, radius: int, blocks: int = 4, most: int = 4_000) -> DataFrame:
    """(f, component, component_id) of each fingerprint of docs (id, f): a fingerprint that names the component, and its smallest id."""
    prints = docs.groupBy("f").agg(F.min("id").alias("id"))
    # Fingerprints are told apart by themselves while linking: an id could repeat. The smallest id of a component comes last.
    prints = stored(prints, "distinct")
    links = near_links(prints.select("f", F.col("f").alias("id")), radius, blocks, most)
    found = components(links)
    members = prints.join(found.select(F.col("id").alias("f"), "component"), "f", "left").select("f", "id", F.coalesce("component", "f").alias("component"))
    members = stored(members, "members")
    least = members.groupBy("component").agg(F.min("id").alias("component_id"))
    return members.select("f", "component").join(least, "component")


#: Column that names a row by its id and text.
KEY = "near_key__"


def same_id(a: str, b: str) -> Column:
    """Null is the same as null. In a form that Spark doesn't take for another key of a join."""
    return F.when(F.col(a).isNull() | F.col(b).isNull(), F.col(a).isNull() & F.col(b).isNull()).otherwise(F.col(a) == F.col(b))


def keep_one(df: DataFrame, members: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """members (id, h: hash of id and text, component): one row of df, which has h as KEY, for each component with ids, with its smallest id; rows with a null id
    stay. `rows` (id, h) is df in short: only where an id repeats with its text are such copies looked for."""
    first = members.where(F.col("id").isNotNull()).groupBy("component").agg(F.min(F.struct("id", "h")).alias("x")).select(F.col("x.id").alias("_id"), F.col("x.h").alias("_h"))
    named = df.where(F.col(id_col).isNotNull())
    kept = named.join(first, (F.col(KEY) == F.col("_h")) & same_id(id_col, "_id"), "left_semi")
    if rows.where(F.col("id").isNotNull()).groupBy("id", "h").count().where(F.col("count") > 1).take(1):
        kept = kept.dropDuplicates([id_col, KEY])
    return kept.unionByName(df.where(F.col(id_col).isNull()))


def one_of_each(df: DataFrame, radius: int | None = None, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of df for each group of near-duplicates, with its smallest id, all columns kept. With a radius, fingerprints within so many bits link, as in
    `near_duplicates`; else shingle sets of this Jaccard similarity, see `near_copies`. Null and repeated ids are handled as there."""
    if radius is None:
        from sedimenta.llm import near_copies

        return near_copies.one_of_each(df, similarity, words, id_col, text_col)
    df, names = bucketed(df.withColumn(KEY, F.xxhash64(F.col(id_col), text_or_empty(text_col))), KEY, "by_text"), df.columns
    rows = df.select(F.col(id_col).alias("id"), F.col(KEY).alias("h"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fingerprints(b.column(2).to_pylist(), words).view(np.int64))], ["id", "h", "f"])

    docs = stored(rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("f", T.LongType())])), "fingerprints")
    return keep_one(df, docs.join(_members(docs, radius), "f").select("id", "h", "component"), docs, id_col).select(*(F.col(f"`{c}`") for c in names))
