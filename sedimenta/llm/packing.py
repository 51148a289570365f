"""Best-fit packing of token sequences under several capacities at once.

Every piece is a vector (tokens, one document, attention cost = tokens squared), and all three follow from its length. So the whole
corpus reduces to a histogram of at most `max_tokens` lengths, however many documents there are: the driver packs the histogram (vector
best-fit decreasing, many equal pieces and equal bins in one step), and the pieces then look up their place by their length and their rank
among the pieces of that length. Ranks come from counts per task, so that a length which holds a third of all pieces is no hot group."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm import bpe
from sedimenta.llm.common import OUT_ROWS, running_base, stored, text_or_empty


class Capacity(NamedTuple):
    """What one sequence holds at most. The defaults for documents and cost never bind beyond the tokens."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048

    def piece(self) -> int:
        """The longest piece that fits alone."""
        return min(self.tokens, math.isqrt(self.cost))


def fit(histogram: dict[int, int], capacity: Capacity, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), score: str = "norm") -> np.ndarray:
    """Vector best-fit decreasing over a histogram length -> count. Rows (length, first rank, count, first sequence, offset): the pieces of that length
    with ranks first rank + k, k < count, go to sequence first sequence + k at this offset.

    Among the open bins with room in every capacity, score "norm" takes the one whose residual, as shares of the capacities, has the
    smallest weighted norm after the piece; "dot" the one with the largest weighted dot product of residual and piece. Bins with the same
    residual are one state, so the work depends on the number of lengths, not of pieces."""
    caps, w = np.array(capacity, float), np.array(weights, float)
    left, count, bins = np.zeros((1024, 3), np.int64), np.zeros(1024, np.int64), [[] for _ in range(1024)]
    where: dict[tuple, int] = {}
    used, bin_at, plan = 0, 0, []

    def add(state: tuple[int, int, int], spans: list[tuple[int, int]]) -> None:
        nonlocal left, count, used
        if state[0] <= 0 or state[1] <= 0 or state[2] <= 0:
            return
        k = where.get(state)
        if k is None:
            if used == len(count):
                live = np.flatnonzero(count[:used])
                if len(live) > used // 2:
                    left, count = np.vstack([left, np.zeros_like(left)]), np.concatenate([count, np.zeros_like(count)])
                    bins.extend([] for _ in range(used))
                else:
                    left[: len(live)], count[: len(live)] = left[live], count[live]
                    bins[: len(live)] = [bins[x] for x in live]
                    used = len(live)
                    count[used:] = 0
                    where.clear()
                    where.update({tuple(int(v) for v in left[x]): x for x in range(used)})
            k, used = used, used + 1
            left[k], where[state], bins[k] = state, k, []
        count[k] += sum(n for _, n in spans)
        bins[k] += spans

    for length in sorted(histogram, reverse=True):
        item, rest, rank = np.array([length, 1, length * length]), histogram[length], 0
        while rest:
            room = np.flatnonzero((count[:used] > 0) & (left[:used] >= item).all(axis=1))
            if not len(room):
                break
            shares = (left[room] - item) / caps
            value = (w * shares * shares).sum(axis=1) if score == "norm" else -(w * (left[room] / caps) * (item / caps)).sum(axis=1)
            k = int(room[np.argmin(value)])
            take, state = int(min(rest, count[k])), tuple(int(x) for x in left[k])
            offset, moved, need = capacity.tokens - state[0], [], take
            while need:
                lo, n = bins[k].pop()
                m = min(n, need)
                if n > m:
                    bins[k].append((lo, n - m))
                moved.append((lo + n - m, m))
                plan.append((length, rank, m, lo + n - m, offset))
                rank, need = rank + m, need - m
            count[k] -= take
            if not count[k]:
                where.pop(state, None)
            rest -= take
            add((state[0] - length, state[1] - 1, state[2] - length * length), moved)
        each = min(capacity.tokens // length, capacity.documents, capacity.cost // (length * length))
        for per, n in ((each, rest // each), (rest % each, 1)):
            if per and n:
                for j in range(per):
                    plan.append((length, rank, n, bin_at, j * length))
                    rank += n
                add((capacity.tokens - per * length, capacity.documents - per, capacity.cost - per * length * length), [(bin_at, n)])
                bin_at += n
    return np.array(plan, np.int64).reshape(-1, 5)


def _small(ids: memoryview) -> bytes:
    own = np.frombuffer(ids, "<u4")
    narrow = bool(own.max(initial=0) < 2**16)
    return bytes([narrow]) + zlib.compress(own.astype("<u2").tobytes() if narrow else ids, 1)


def _whole(data: bytes) -> bytes:
    own = zlib.decompress(memoryview(data)[1:])
    return np.frombuffer(own, "<u2").astype("<u4").tobytes() if data[0] else own


def pieces(df: DataFrame, tokenizer: str, longest: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and then end_id, cut, if longer than `longest`, so that only the first piece is shorter. With them
    the task that made them (part) and their rank among that task's pieces of the same length; with `ids` also the ids, in 16 bits where that does and compressed, for the way to their place."""
    spec = bpe.load(df.sparkSession, tokenizer)
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    longs = ["piece", "start", "length", "ids_crc32", "part", "part_rank"]
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *(T.StructField(x, T.IntegerType() if x == "piece" else T.LongType()) for x in longs), *([T.StructField("ids", T.BinaryType())] if ids else [])])
    kinds = [pa.int32(), *[pa.int64()] * (len(longs) - 1), *([pa.binary()] if ids else [])]

    def made(b: pa.RecordBatch, row: list[int], out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True))], schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = bpe.encoder(spec), end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, np.int64)
        for b in batches:
            row, out = [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                data = memoryview(encode(text) + end)
                n, at, piece = len(data) // 4, 0, 0
                while at < n:
                    size = (n - at) % longest or longest
                    row.append(k)
                    own = data[4 * at : 4 * (at + size)]
                    out.append((piece, at, size, zlib.crc32(own), part, int(seen[size]), *([_small(own)] if ids else [])))
                    seen[size] += 1
                    at, piece = at + size, piece + 1
                    if len(out) >= OUT_ROWS:
                        yield made(b, row, out)
                        row, out = [], []
            if out:
                yield made(b, row, out)

    return rows.mapInArrow(cut, schema)


def pack(df: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", weights: tuple[float, float, float] = (1.0, 0.01, 0.01), score: str = "norm", ids: bool = False) -> DataFrame:
    """One row for each piece: the id, piece, start, length, ids_crc32, sequence_id, offset, and with `ids` its ids (bytes, little-endian in 32 bits).

    A null or empty text is the end id alone. Null and repeated ids are documents of their own. Documents longer than a sequence are cut,
    nothing is dropped. An empty table gives an empty result. Other columns are not read."""
    if min(capacity) < 1 or score not in ("norm", "dot"):
        raise ValueError("capacities are positive; score is norm or dot")
    longest = capacity.piece()
    spark = df.sparkSession
    made = stored(pieces(df, tokenizer, longest, end_id, id_col, text_col, ids), "pieces")
    histogram = {r[0]: r[1] for r in made.groupBy("length").count().collect()}  # at most `longest` rows
    plan = fit(histogram, capacity, weights, score)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # The plan has rows by length and state, some ten thousand; were it ever large, it would fail here rather than on the executors.
    if plan.nbytes > 256 * 2**20:
        raise ValueError("the packing plan is over 256 MB; use fewer distinct capacities")
    sent = spark.sparkContext.broadcast(plan)
    counts = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    based = made.join(running_base(counts, "length", "part", "n", "base"), ["length", "part"])
    fields = [made.schema[x] for x in (id_col, "piece", "start", "length", "ids_crc32")]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), *([T.StructField("ids", T.BinaryType())] if ids else [])])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        keys = plan[:, 0] * (1 << 42) + plan[:, 1]
        for b in batches:
            length, rank = b.column(3).to_numpy(zero_copy_only=False), b.column(5).to_numpy(zero_copy_only=False)
            k = np.searchsorted(keys, length * (1 << 42) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(plan[k, 3] + rank - plan[k, 1]), pa.array(plan[k, 4]), *(pa.array([_whole(x) for x in c.to_pylist()], pa.binary()) for c in b.columns[6:])], [*schema.names])

    return based.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("part_rank")).alias("rank"), *(["ids"] if ids else [])).mapInArrow(place, schema)
