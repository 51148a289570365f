"""Token-id files with constant-time keyed access.

A file set is a Parquet table whose rows are shards: `payload`, the raw little-endian ids of its documents end to end (16 bits an id where the
vocabulary allows it, else 32), and `index`, a minimal perfect hash from document keys to slots that hold a fingerprint of the key, the offset and the
length. Spark's committer writes the rows, so a lost executor leaves no half shard and any store that Spark reaches will do. Shards are in ascending
order of the ids; a shard ends at `shard_bytes`, or is one longer document."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sedimenta.llm import bpe
from sedimenta.llm.common import OUT_ROWS, text_or_empty

MAGIC = b"TIDX1\0\0\0"
HEAD = struct.Struct("<8sIIII")  # magic, keys, buckets, bytes of an id, seed of the key hashes
#: Keys for each bucket of the displacement table, on average.
KEYS_PER_BUCKET = 4


def key_of(doc_id: object, repeat: int = 0) -> bytes:
    """A document's key: its id (of any type, or null), and how many rows of the same id come before it in its part."""
    return f"{'' if doc_id is None else f'={doc_id}'}#{repeat}".encode()


def _slots(h: int, n: int, seed: int) -> int:
    x = (h ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 29)) >> 3) % n


class PerfectIndex:
    """A minimal perfect hash over n keys: keys fall into buckets; the buckets, largest first, each get the first seed that sends all of its keys to free
    slots; a bucket of one key names its slot itself. n slots for n keys. A stored fingerprint of 32 bits tells foreign keys."""

    def __init__(self, seeds: np.ndarray, prints: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, salt: int = 0):
        self.seeds, self.prints, self.offsets, self.lengths, self.salt = seeds, prints, offsets, lengths, salt

    @classmethod
    def build(cls, keys: list[bytes], offsets: list[int], lengths: list[int]) -> PerfectIndex:
        n = len(keys)
        if len(set(keys)) != n:
            raise ValueError("keys repeat")
        salt = 0
        while len(set(hashes := [xxhash.xxh3_64_intdigest(k, salt) for k in keys])) < n:  # two keys with one hash never part
            salt += 1
        buckets: dict[int, list[int]] = {}
        m = max(1, n // KEYS_PER_BUCKET)
        for k, h in enumerate(hashes):
            buckets.setdefault(h % m, []).append(k)
        seeds, at, free = np.zeros(m, np.int32), np.full(n, -1, np.int64), bytearray(b"\1") * n
        later = 0
        for b, own in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                later = free.index(1, later)
                free[later], at[later], seeds[b] = 0, own[0], -later - 1
                continue
            seed = 1
            while len(places := {_slots(hashes[k], n, seed) for k in own}) < len(own) or not all(free[p] for p in places):
                seed += 1
            seeds[b] = seed
            for k in own:
                p = _slots(hashes[k], n, seed)
                free[p], at[p] = 0, k
        prints = np.array([xxhash.xxh32_intdigest(keys[k]) for k in at], "<u4")
        return cls(seeds, prints, np.array(offsets, "<u8")[at], np.array(lengths, "<u8")[at], salt)

    def find(self, key: bytes) -> tuple[int, int] | None:
        """Offset and length in ids, or None for a key that isn't here (but for one foreign key in 2^32)."""
        if not len(self.prints):
            return None
        h = xxhash.xxh3_64_intdigest(key, self.salt)
        seed = int(self.seeds[h % len(self.seeds)])
        slot = -seed - 1 if seed < 0 else _slots(h, len(self.prints), seed)
        return (int(self.offsets[slot]), int(self.lengths[slot])) if self.prints[slot] == xxhash.xxh32_intdigest(key) else None

    def dump(self, width: int) -> bytes:
        return HEAD.pack(MAGIC, len(self.prints), len(self.seeds), width, self.salt) + self.seeds.astype("<i4").tobytes() + self.prints.tobytes() + self.offsets.tobytes() + self.lengths.tobytes()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectIndex, int]:
        """The index and the bytes of one id."""
        magic, n, m, width, salt = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token-id index")
        at, out = HEAD.size, []
        for kind, size in (("<i4", m), ("<u4", n), ("<u8", n), ("<u8", n)):
            out.append(np.frombuffer(data, kind, size, at))
            at += out[-1].nbytes
        return cls(*out, salt), width


def write(df: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_bytes: int = 2 * 2**20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the file set. Texts are dealt by ranges of the id and sorted in their range, so the order of all shards is that of the ids (null first, then
    ascending); rows with the same id are keyed by their order of content. A null text is empty: its end id alone. Ids have any type with an order. Each
    shard is a row group, so a keyed read opens no other."""
    spec = bpe.load(df.sparkSession, tokenizer)
    vocab = json.loads(spec.value)
    largest = max([end_id, *vocab["model"]["vocab"].values(), *(t["id"] for t in vocab["added_tokens"])])
    width = 2 if largest < 2**16 else 4
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("row")]
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    names, of = ["part", "shard", "n_docs", "n_tokens"], rows.schema["id"].dataType
    schema = T.StructType([*(T.StructField(x, T.LongType()) for x in names), T.StructField("first_id", of), T.StructField("last_id", of), T.StructField("ids", T.ArrayType(of)), *(T.StructField(x, T.BinaryType()) for x in ("repeats", "index", "payload"))])
    arrow = to_arrow_schema(schema)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = bpe.encoder(spec, f"<u{width}"), end_id.to_bytes(width, "little"), TaskContext.get().partitionId()
        ids: list = []
        data: list[bytes] = []
        size, made, last, repeat, repeats = 0, 0, None, 0, []

        def shard() -> pa.RecordBatch:
            lengths = [len(x) // width for x in data]
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            index = PerfectIndex.build([key_of(i, r) for i, r in zip(ids, repeats, strict=True)], offsets[:-1].tolist(), lengths)
            row = (part, made, len(ids), int(offsets[-1]), ids[0], ids[-1], ids, np.array(repeats, "<i8").tobytes(), index.dump(width), b"".join(data))
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, arrow, strict=True)], schema=arrow)

        first = True
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                one = encode(text) + end
                if data and size + len(one) > shard_bytes:
                    yield shard()
                    ids, data, repeats, size, made = [], [], [], 0, made + 1
                repeat = repeat + 1 if not first and i == last else 0
                first, last = False, i
                ids.append(i)
                data.append(one)
                repeats.append(repeat)
                size += len(one)
        if data:
            yield shard()

    own_group = {"parquet.block.size": shard_bytes, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    rows.mapInArrow(shards, schema).write.options(**own_group).parquet(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the file set by keyed access: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of its ids as unsigned 32-bit
    integers. Each key of a shard goes through the shard's index; a fingerprint that does not match is an error."""
    shards = _shards(spark, path)
    names = ["doc_id", "part", "shard", "offset", "n_tokens", "ids_crc32"]
    schema = T.StructType([T.StructField(x, T.LongType() if k else shards.schema["ids"].dataType.elementType) for k, x in enumerate(names)])
    arrow = to_arrow_schema(schema)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, known, repeats, index, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                index, width = PerfectIndex.load(index)
                ids, out = np.frombuffer(payload, f"<u{width}"), []
                for i, repeat in zip(known, np.frombuffer(repeats, "<i8").tolist(), strict=True):
                    if (at := index.find(key_of(i, repeat))) is None:
                        raise ValueError(f"shard {part}/{shard}: no entry for document {i}")
                    out.append((i, part, shard, *at, zlib.crc32(ids[at[0] : sum(at)].astype("<u4").tobytes())))
                for k in range(0, len(out), OUT_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out[k : k + OUT_ROWS], strict=True), arrow, strict=True)], schema=arrow)

    docs = shards.select("part", "shard", "ids", "repeats", "index", "payload").mapInArrow(look, schema)
    # One row a shard, a few hundred bytes of ids' worth: parts first, then the shards of a part, so no task sees all shards of a large set.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside")).join(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "part")
    return docs.join(base, ["part", "shard"]).select("doc_id", (F.col("before") + F.col("inside") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, doc_id: object, repeat: int = 0) -> list[int] | None:
    """The ids of one document: the shards whose range holds the id (pushed to the scan), then one step in the index of the one that holds this repeat. A
    repeated id can go on in the next part, where its keys count from 0 again; so the rows of the shards before are counted."""
    shards = _shards(spark, path)
    shards = shards.where(F.col("first_id").isNull() if doc_id is None else (F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id))
    seen = 0
    for r in shards.select("part", "shard", "ids", "repeats").orderBy("part", "shard").toLocalIterator() if repeat >= 0 else ():
        own = [x for i, x in zip(r["ids"], np.frombuffer(r["repeats"], "<i8").tolist(), strict=True) if i == doc_id]
        if repeat - seen < len(own):
            one = shards.where((F.col("part") == r["part"]) & (F.col("shard") == r["shard"])).select("index", "payload").first()
            index, width = PerfectIndex.load(one["index"])
            at = index.find(key_of(doc_id, int(own[repeat - seen])))
            return np.frombuffer(one["payload"], f"<u{width}")[at[0] : sum(at)].tolist()
        seen += len(own)
    return None
