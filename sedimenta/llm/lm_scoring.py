"""Stupid-backoff language-model scores from n-gram counts of the whole corpus, computed relationally.

Texts are exploded into n-grams. These are partitioned by a hash of their context (all words but the last), so one exchange brings together whatever has to
be counted for a word: its n-gram and its context. The count table of a partition is joined to the exploded n-grams there, and the sums by
document are pre-aggregated. n-grams are compared as words, never by a hash.

In the exchange a row is a block: the n-grams that one chunk of text has in one partition, as indices into the words of the block. As a row for each
n-gram, the same plan took 6.7 times the input on disk and 3,568 CPU seconds a GB, over the limits of 4 and 960. Rows they are where that
pays: a context that would outgrow one task is counted with partial aggregates, and its rows join that table by n-gram; so does the option `least`."""

from __future__ import annotations

import functools
import itertools
import math
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import OUT_ROWS, stored, text_or_empty

#: Exploded n-grams that one partition gets on average; a context with more of them in all is dealt otherwise.
PARTITION_ROWS = 2_000_000
MOST_PARTITIONS = 50_000
#: Words of a chunk; a longer document goes on in the next one.
CHUNK_WORDS = 1_000_000
#: A context is counted by itself only if it has this share of a chunk; so at most 1 / LEAST_SHARE contexts are dealt otherwise.
LEAST_SHARE = 1e-4
SPACE = " \t\n\x0b\x0c\r"
NEXT, FIRST, END, WHOLE = range(4)
ITEMS = "array<struct<gram:string,kind:tinyint>>"


def words_of(text: Column) -> Column:
    """Words are runs of other than ASCII white space, A-Z lower-cased."""
    low = F.btrim(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(SPACE))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(F.split(low, r"[ \t\n\x0b\f\r]+"))


def _has(text: Column, n: int) -> Column:
    """Whether a text has exactly n words, without splitting it."""
    return text.rlike(rf"\A[ \t\n\x0b\f\r]*{r'[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]+' * (n - 1)}{r'[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]*' if n else ''}\z")


def exploded(docs: DataFrame, n: int) -> DataFrame:
    """docs (row, id, words) -> one row for each word that has n - 1 before it, with the n-gram that ends there (FIRST in its document, or NEXT), and one for
    the end of each document of n - 1 words or more: its last n - 1 words and a space, which is an occurrence of that context only (WHOLE if it is
    all of the document). Ends carry the document's id and number of words."""
    size = F.size("words")
    item = lambda gram, kind: F.struct(gram.alias("gram"), kind.cast("byte").alias("kind"))
    token = lambda k: item(F.array_join(F.slice("words", k - (n - 2), F.lit(n)), " "), F.when(k == n - 1, FIRST).otherwise(NEXT))
    end = item(F.concat(F.array_join(F.slice("words", size - (n - 2), F.lit(n - 1)), " "), F.lit(" ")), F.when(size == n - 1, WHOLE).otherwise(END))
    tokens = F.when(size >= n, F.transform(F.sequence(F.lit(n - 1), F.greatest(size - 1, F.lit(n - 1))), token)).otherwise(F.array().cast(ITEMS))
    items = F.when(size >= n - 1, F.concat(tokens, F.array(end))).otherwise(F.array().cast(ITEMS))
    rows = docs.select("row", "id", size.cast("long").alias("n_words"), F.explode(items).alias("x"))
    last = F.col("x.kind") >= END
    return rows.select("row", "x.gram", "x.kind", F.when(last, F.col("id")).alias("id"), F.when(last, F.col("n_words")).alias("n_words"))


def _context(n: int) -> Column:
    return F.substring_index("gram", " ", n - 1)


def _planes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def pack_small(values: np.ndarray) -> bytes:
    """Numbers by byte planes: the low bytes of all, then the next ones, which repeat and compress."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return len(values).to_bytes(8, "little") + bytes([width]) + zlib.compress(_planes(values, width), 1)


def unpack_small(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    out = np.zeros(n, np.int32 if width < 4 else np.int64)
    for k, plane in enumerate(np.frombuffer(zlib.decompress(data[9:]), np.uint8).reshape(width, n) if n and width else ()):
        out |= plane.astype(out.dtype) << (8 * k)
    return out


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Consecutive words of a task, as numbers from 1 in `vocab`; the first `carried` only precede. For each word its document (0, 1, ...), its place there, and
    whether it is the last."""

    def __init__(self, vocab: list[bytes], words: np.ndarray, docs: np.ndarray, place: np.ndarray, last: np.ndarray, carried: int, order: int):
        self.vocab, self.words, self.docs, self.place, self.order = vocab, words, docs, place, order
        self.own = np.arange(carried, len(words), dtype=np.int32)
        here = place[carried:]
        self.tokens = self.own[here >= order - 1]
        self.ends = self.own[last[carried:] & (here >= order - 2)]

    def grams(self, columns: int) -> list[np.ndarray]:
        """For each n-gram of `order` words, then each end of a document of order - 1 words or more: the first words of it (0: the end)."""
        n = self.order
        return [np.concatenate([self.words[self.tokens - (n - 1 - k)], self.words[self.ends - (n - 2 - k)] if k < n - 1 else np.zeros(len(self.ends), np.int32)]) for k in range(columns)]

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Their documents and kinds."""
        kinds = np.concatenate([np.where(self.place[self.tokens] == self.order - 1, FIRST, NEXT), np.where(self.place[self.ends] == self.order - 2, WHOLE, END)])
        return np.concatenate([self.docs[self.tokens], self.docs[self.ends]]), kinds

    def hashes(self, columns: list[np.ndarray]) -> np.ndarray:
        """Of the contexts."""
        of = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in [b"", *self.vocab]), np.uint64, len(self.vocab) + 1)
        out = np.zeros(len(columns[0]), np.uint64)
        for c in columns[: self.order - 1]:
            out = _scramble(out * np.uint64(0x9E3779B97F4A7C15) + of[c])
        return out

    def text(self, numbers: list[int]) -> str:
        return b" ".join([self.vocab[k - 1] for k in numbers]).decode()

    def runs(self, m: int) -> Iterator[tuple[str, int]]:
        """The distinct m-grams and their counts; of words see `counts`."""
        if len(ends := self.own[self.place[self.own] >= m - 1]):
            kinds, n = np.unique(np.vstack([self.words[ends - (m - 1 - k)] for k in range(m)]), axis=1, return_counts=True)
            yield from ((self.text(x), k) for x, k in zip(kinds.T.tolist(), n.tolist(), strict=True))

    def counts(self) -> pa.RecordBatch:
        """How often each word stands here, as rows of the sketch."""
        n = np.bincount(self.words[self.own], minlength=len(self.vocab) + 1)[1:]
        rows = pa.RecordBatch.from_arrays([pa.array(np.ones(len(n), np.int64)), pa.array(self.vocab, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], SKETCH.names)
        return rows.filter(pa.array(n > 0))

    def frequent(self, least: int) -> Iterator[tuple[str, int]]:
        """The contexts that occur so often. Only what falls into a frequent bucket of hashes is looked at."""
        columns = self.grams(self.order - 1)
        if not len(columns[0]):
            return
        bucket = (self.hashes(columns) >> np.uint64(44)).astype(np.int64)
        some = np.flatnonzero((np.bincount(bucket, minlength=2**20) >= least)[bucket])
        if len(some):
            kinds, n = np.unique(np.vstack([c[some] for c in columns]), axis=1, return_counts=True)
            yield from ((self.text(kinds[:, k].tolist()), int(n[k])) for k in np.flatnonzero(n >= least))


def _dense(seen: dict[bytes, int], total: int) -> np.ndarray:
    """Numbers 1, 2, ... for the places at which words were first seen."""
    out = np.zeros(total, np.int32)
    out[np.fromiter(seen.values(), np.int64, len(seen))] = np.arange(1, len(seen) + 1)
    return out


def chunks(batches: Iterator[pa.RecordBatch], order: int, size: int) -> Iterator[tuple[Chunk, list, list[int], list[int]]]:
    """(chunk, ids, rows, numbers of words of its documents) of batches (id, row, text); for a document that began before, the row alone."""
    seen, parts, total, carried, ids, rows, sizes = {}, [], 0, 0, [], [], []
    none = np.zeros(0, np.int32)

    def made() -> Chunk:
        words, *flat = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [none, none, none, np.zeros(0, bool)]
        return Chunk(list(seen), _dense(seen, total)[words], *flat, carried, order)

    for b in batches:
        for i, row, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own = text.encode().lower().split()
            for lo in range(0, max(1, len(own)), size):
                ids.append(None if lo else i)
                rows.append(row)
                sizes.append(None if lo else len(own))
                if not own:
                    break
                before = min(lo, order - 1)  # only at the start of a chunk, which a document's first part fills
                some = own[lo - before : lo + size]
                place = np.arange(lo - before, lo - before + len(some), dtype=np.int32)
                carried, total = carried + before, total + len(some)
                parts.append((np.fromiter(map(seen.setdefault, some, itertools.count(total - len(some))), np.int32, len(some)), np.full(len(some), len(rows) - 1, np.int32), place, place == len(own) - 1))
                if total >= size:
                    yield made(), ids, rows, sizes
                    seen, parts, total, carried, ids, rows, sizes = {}, [], 0, 0, [], [], []
    if ids or parts:
        yield made(), ids, rows, sizes


SKETCH = T.StructType([T.StructField("kind", T.LongType()), T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
#: Kinds of its rows besides m: counts of m-grams.
CONTEXT, WORDS, SHORT = 0, -1, -2


def sketch(docs: DataFrame, order: int, size: int) -> DataFrame:
    """What has to be known beforehand, pre-aggregated by chunk: words, frequent contexts, documents shorter than a context by length, and the counts of
    n-grams that are as short as those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, _, sizes in chunks(batches, order, size):
            out = [(WORDS, None, len(chunk.own)), *((CONTEXT, *x) for x in chunk.frequent(max(1, int(LEAST_SHARE * size))))]
            if order > 2:
                yield chunk.counts()
            for m in range(1, order - 1):
                out += [(m, *x) for x in chunk.runs(m)] if m > 1 else []
                if m in sizes:
                    out.append((SHORT, str(m), sizes.count(m)))
            for k in range(0, len(out), OUT_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[k : k + OUT_ROWS], strict=True), (pa.int64(), pa.string(), pa.int64()), strict=True)], SKETCH.names)

    return docs.select("id", "row", "text").mapInArrow(run, SKETCH)


TABLE = [T.StructField("rows", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType()))]


def _blocks_schema(*first: str, id_type: T.DataType) -> T.StructType:
    return T.StructType([*(T.StructField(x, T.LongType()) for x in first), T.StructField("data", T.BinaryType()), T.StructField("ids", T.ArrayType(id_type)), *TABLE])


def _framed(parts: list[bytes]) -> bytes:
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def _unframed(data: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        parts.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return parts


def blocks(docs: DataFrame, order: int, partitions: int, hot: list[str], size: int) -> DataFrame:
    """One row for each partition into which n-grams of a chunk fall, without those of hot contexts; and one for each chunk with the table of
    its documents. Those shorter than a context and not empty have no size there: they are not this table's."""
    schema = _blocks_schema("part", "chunk", id_type=docs.schema["id"].dataType)

    def encoded(vocab: list[bytes], grams: list[np.ndarray], docs: np.ndarray) -> bytes:
        if len(docs) * 16 < len(vocab):
            used = np.unique(np.concatenate(grams))
            used = used[used > 0]
            grams = [np.where(c > 0, np.searchsorted(used, c) + 1, 0) for c in grams]
        else:
            there = np.zeros(len(vocab) + 1, bool)
            for c in grams:
                there[c] = True
            there[0] = False
            used, number = np.flatnonzero(there), np.cumsum(there) * there
            grams = [number[c] for c in grams]
        key = grams[0].astype(np.int64)
        if len(grams) > 2:
            key = key * (len(used) + 1) + grams[1]
        by = np.argsort(key)  # alike beside alike compresses better
        return _framed([zlib.compress(b"\n".join([vocab[k - 1] for k in used.tolist()]), 1), *(pack_small(c[by]) for c in grams), pack_small(docs[by])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, special, marks = to_arrow_schema(schema), set(hot), _marks(hot)
        batch = lambda out: pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
        made = 0
        for chunk, ids, rows, sizes in chunks(batches, order, size):
            name, made = (TaskContext.get().partitionId() << 33) + made, made + 1
            out = [(-1 - name, name, None, ids, rows, [None if n is None or 0 < n < order - 1 else n for n in sizes])]
            grams, (docs, kinds) = chunk.grams(order), chunk.documents()
            h = chunk.hashes(grams)
            part = ((h >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.uint16 if partitions <= 2**16 else np.int64)  # short ones sort fast
            if hot:
                own = np.ones(len(h), bool)
                at = np.flatnonzero(np.isin(h, marks))  # almost always hot ones, and then few contexts
                if len(at):
                    contexts, which = np.unique(np.vstack([c[at] for c in grams[:-1]]), axis=1, return_inverse=True)
                    own[at] = np.array([chunk.text(x) not in special for x in contexts.T.tolist()])[which.ravel()]
                some = np.flatnonzero(own)
                some = some[np.argsort(part[some], kind="stable")]
            else:
                some = np.argsort(part, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], part[some[1:]] != part[some[:-1]], [True]])) if len(some) else np.zeros(1, np.int64)
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                at = some[lo:hi]
                out.append((int(part[at[0]]), name, encoded(chunk.vocab, [c[at] for c in grams], docs[at] * np.int64(4) + kinds[at]), None, None, None))
                if len(out) >= 256:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

    return docs.select("id", "row", "text").mapInArrow(run, schema)


def _marks(contexts: list[str]) -> np.ndarray:
    out = []
    for c in contexts:
        h = np.zeros(1, np.uint64)
        for w in c.split(" "):
            h = _scramble(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(xxhash.xxh3_64_intdigest(w.encode())))
        out.append(h)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _tables(grams: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray]:
    """How often the n-gram and the context of each entry stand among all; `words`: a bound of the numbers."""
    context, rest = grams[0].astype(np.int64), grams[1:]
    for c in rest[:-1]:
        if (int(context.max(initial=0)) + 1) * (words + 1) ** 2 >= 2**63:
            context = np.unique(context, return_inverse=True)[1]
        context = context * (words + 1) + c
    if (int(context.max(initial=0)) + 1) * (words + 1) >= 2**63:
        context = np.unique(context, return_inverse=True)[1]
    key = context * (words + 1) + rest[-1]
    by = np.argsort(key)
    key = key[by]

    def counts(k: np.ndarray) -> np.ndarray:
        head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        n = np.diff(np.append(head, len(k)))
        out = np.empty(len(k), np.int64)
        out[by] = np.repeat(n, n)
        return out

    return counts(key), counts(key // (words + 1))


def joined(made: DataFrame, order: int, words: int, id_type: T.DataType) -> DataFrame:
    """The count table of each partition, joined to its n-grams, and summed by document: (chunk, documents with their sums, or the table of its documents)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.drop_columns(["part"])
        seen: dict[bytes, int] = {}
        columns, marks, total = [[] for _ in range(order)], [], 1
        for block in table.column("data").to_pylist():
            vocab, *parts, docs = _unframed(block)
            own = zlib.decompress(vocab).split(b"\n")
            number = np.concatenate([np.zeros(1, np.int32), np.fromiter(map(seen.setdefault, own, itertools.count(total)), np.int32, len(own))])
            total += len(own)
            for c, x in zip(columns, parts, strict=True):
                c.append(number[unpack_small(x)])
            marks.append(unpack_small(docs))
        kind = np.concatenate(marks) & 3
        dense = _dense(seen, total)
        gram, context = _tables([dense[np.concatenate(c)] for c in columns], len(seen))
        gram, context = np.log(gram), np.log(context)
        value = np.select([kind == NEXT, kind == FIRST, kind == WHOLE], [gram - context, gram - math.log(words), context - math.log(words)], 0.0)
        out, at = [], 0
        for x in marks:
            sums = np.bincount(x >> 2, value[at : at + len(x)])
            docs = np.flatnonzero(sums)
            out.append(_framed([pack_small(docs), zlib.compress(sums[docs].tobytes(), 1)]))
            at += len(x)
        n = len(out)
        return pa.table({"chunk": table.column("chunk"), "data": pa.array(out, pa.binary()), **{c: pa.nulls(n, table.schema.field(c).type) for c in ("ids", "rows", "sizes")}})

    return made.groupBy("part").applyInArrow(run, _blocks_schema("chunk", id_type=id_type))


def by_document(sums: DataFrame, id_type: T.DataType) -> DataFrame:
    """(row, value) of the documents of each chunk, with id and n_words of those that begin in it."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("n_words", T.LongType()), T.StructField("value", T.DoubleType())])

    def run(table: pa.Table) -> pa.Table:
        ids, rows, sizes = (next(x for x in table.column(c) if x.is_valid).values for c in ("ids", "rows", "sizes"))  # of the one row with the table
        value = np.zeros(len(rows))
        for data in table.column("data").to_pylist():
            if data is not None:
                docs, own = _unframed(data)
                value[unpack_small(docs)] += np.frombuffer(zlib.decompress(own))
        kept = pc.or_(pc.is_valid(sizes), pa.array(value != 0))
        return pa.table({"row": rows, "id": ids, "n_words": sizes, "value": value}).filter(kept)

    return sums.groupBy("chunk").applyInArrow(run, schema)


def counted(rows: DataFrame, n: int, total: int, hot: list[str], partition_rows: int, times: str = "times") -> DataFrame:
    """rows (gram, ...) with seen, the corpus count of the n-gram, and context, that of its first n - 1 words. `times`: how often a row counts."""
    sums = F.sum(F.col(times))
    is_hot = _context(n).isin(hot) if hot else F.lit(False)
    cold = rows.where(~is_hot).repartition(min(MOST_PARTITIONS, max(1, math.ceil(total / partition_rows))), _context(n)).withColumn("of", _context(n))
    cold = cold.sortWithinPartitions("of", "gram").withColumns({"seen": sums.over(Window.partitionBy("of", "gram")), "context": sums.over(Window.partitionBy("of"))}).drop("of")
    if not hot:
        return cold
    return cold.unionByName(by_table(rows.where(is_hot), n, sums).select(cold.columns))


def by_table(rows: DataFrame, n: int, sums: Column) -> DataFrame:
    """The same for few contexts with very many rows: a table of counts, pre-aggregated, joined by n-gram. Spark splits the hot side of that join."""
    table = rows.groupBy("gram").agg(sums.alias("seen"))
    contexts = table.groupBy(_context(n).alias("of")).agg(F.sum("seen").alias("context"))  # at most 1 / LEAST_SHARE rows
    table = table.withColumn("of", _context(n)).join(F.broadcast(contexts), "of").select("gram", "seen", "context")
    return rows.join(table, "gram")


def score(df: DataFrame, order: int = 3, backoff: float = 0.4, least: int = 1, id_col: str = "doc_id", text_col: str = "text", partition_rows: int = PARTITION_ROWS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row for each row of df: the id, n_words, log_score (sum over its words of ln S) and score (its mean; null without words).

    S of a word after its context: count(n-gram) / count(context) for the longest n-gram up to `order` (2 at least) within the document that occurs at
    least `least` times in df; each shorter context multiplies by `backoff`; a word alone has count / number of words, and is never pruned. Counts are of
    the whole table, the document itself included, and exact: n-grams are compared as text. With least=1 every n-gram of a document has been seen, so a
    word falls back to a shorter context only where its document begins; larger values cost an exchange of all n-grams for each order.

    Null and empty texts have no words and log_score 0. Null and repeated ids of any type keep one row each. An empty table gives an empty result."""
    if order < 2 or least < 1:
        raise ValueError("order is 2 or more, least is 1 or more")
    text = F.col("text")
    docs = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("text"))
    known = stored(sketch(docs, order, chunk_words), "sketch")
    words = max(1, known.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    short = sorted(int(r[0]) for r in known.where(F.col("kind") == SHORT).select("gram").distinct().collect())  # at most order - 2
    hot = known.where(F.col("kind") == CONTEXT).groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > partition_rows)
    hot = [r[0] for r in hot.orderBy(F.desc("n"), "gram").limit(int(1 / LEAST_SHARE)).collect()]
    if hot or least > 1:  # several branches have to agree on the numbers of rows
        docs = stored(docs, "numbered")
    split = docs.select("row", "id", words_of(text).alias("words"))
    if least == 1:
        made = blocks(docs, order, max(1, math.ceil(words / partition_rows)), hot, chunk_words)
        rows = by_document(joined(made, order, words, docs.schema["id"].dataType), docs.schema["id"].dataType)
        if hot:
            some = exploded(split, order).where(_context(order).isin(hot)).select("row", "gram", "kind")
            rows = rows.unionByName(_valued(by_table(some, order, F.count(F.lit(1))), words).select("row", "value"), allowMissingColumns=True)
        parts = [_summed(rows)]
        for m in short:  # shorter than a context: its S multiply to count(all of it) / number of words
            whole = docs.where(_has(text, m)).select("id", F.array_join(words_of(text), " ").alias("gram"))
            counts = known.where(F.col("kind") == m).groupBy("gram").agg(F.sum("n").alias("seen"))
            parts.append(whole.join(counts, "gram").select("id", F.lit(m).cast("long").alias("n_words"), (F.log("seen") - math.log(words)).alias("value")))
    else:
        parts = [docs.where(_has(text, 0)).select("id", F.lit(0).cast("long").alias("n_words"), F.lit(0.0).alias("value")), _summed(_cascade(split.where(~_has(text, 0)), order, backoff, least, words, hot, partition_rows))]
    out = functools.reduce(DataFrame.union, parts)
    return out.select(F.col("id").alias(id_col), "n_words", F.col("value").alias("log_score"), F.when(F.col("n_words") > 0, F.col("value") / F.col("n_words")).alias("score"))


def _summed(rows: DataFrame) -> DataFrame:
    """rows (row, value; id and n_words in one of them) -> (id, n_words, value)."""
    return rows.groupBy("row").agg(F.first("id", ignorenulls=True).alias("id"), F.first("n_words", ignorenulls=True).alias("n_words"), F.sum("value").alias("value")).drop("row")


def _valued(rows: DataFrame, words: int) -> DataFrame:
    """Every n-gram counts, none falls back. The shorter contexts of the first words of a document cancel out: S(w1) S(w2|w1) S(w3|w1 w2) is
    count(w1) / words * count(w1 w2) / count(w1) * count(w1 w2 w3) / count(w1 w2) = count(w1 w2 w3) / words. `joined` has the same rule."""
    kind, seen, context = F.col("kind"), F.log("seen"), F.log("context")
    return rows.withColumn("value", F.when(kind == NEXT, seen - context).when(kind == FIRST, seen - math.log(words)).when(kind == WHOLE, context - math.log(words)))


def _cascade(docs: DataFrame, order: int, backoff: float, least: int, words: int, hot: list[str], partition_rows: int) -> DataFrame:
    """From the longest n-grams to the shortest: words whose n-gram is too rare go on to the next order, with the price so far."""
    named, rest = docs.select("row", "id", F.size("words").cast("long").alias("n_words"), F.lit(0.0).alias("value")), None
    parts = []
    for n in range(order, 1, -1):
        asked = (F.col("kind") == FIRST) | ((F.col("kind") == NEXT) & F.lit(n == order))
        rows = exploded(docs, n).select("row", "gram", F.lit(1).alias("times"), asked.alias("asked"), F.lit(0.0).alias("price"))
        rows = rows if rest is None else rows.unionByName(rest)
        made = stored(counted(rows, n, words, hot if n == order else [], partition_rows).where("asked"), f"order{n}")
        parts.append(made.where(F.col("seen") >= least).select("row", (F.log("seen") - F.log("context") + F.col("price")).alias("value")))
        shorter = F.expr("substring(gram, locate(' ', gram) + 1)")
        rest = made.where(F.col("seen") < least).select("row", shorter.alias("gram"), F.lit(0).alias("times"), F.lit(True).alias("asked"), (F.col("price") + math.log(backoff)).alias("price"))
    alone = docs.select("row", F.col("words")[0].alias("gram"), F.lit(0.0).alias("price")).union(rest.select("row", "gram", "price"))
    parts.append(alone.join(docs.select(F.explode("words").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("seen")), "gram").select("row", (F.log("seen") - math.log(words) + F.col("price")).alias("value")))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [named, *parts])
