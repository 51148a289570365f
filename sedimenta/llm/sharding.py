"""Shards of bounded size by extendible hashing.

The directory is indexed by the leading bits of a hash of the document's key; each entry names a bucket, which is a shorter or equally long prefix. It comes
from a histogram of bytes by prefix: a bucket that holds more than the limit splits on another bit, and only such buckets do. Entries that are
too large at the last bit of the directory get a directory of their own with more bits, so its size follows the number of shards, not the deepest of
them. All of it is aggregation and joins of small rows: texts are measured in the scan, and a row finds its bucket by one look at the
directory. A bucket with one key alone can't split; it fills overflow pages, in the order of a running sum that is taken by task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import checkpointed, running_base, stored

#: Bits of the hash in use.
BITS = 60
#: Bits that the directory has beyond the expected depth; a further directory adds twice as many.
SPARE = 4


def key_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key as text (null: empty)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    return F.shiftright("h", BITS - depth)


def directory(sizes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """sizes (h, n_bytes) -> (bits, entries) of each directory, the first for all rows, the next for those whose entry was too large there. An entry: the
    prefix p, and the depth, bytes and docs of its bucket. Prefixes without rows have none."""
    total = sizes.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    start, bits, out = 0, min(BITS, max(1, math.ceil(math.log2(max(2.0, total / limit))) + SPARE)), []
    while True:
        counts = [F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high")]
        histogram = sizes.select(_prefix(bits).alias("p"), F.col("n_bytes").alias("bytes"), F.lit(1).alias("docs"), F.col("h").alias("low"), F.col("h").alias("high")).groupBy("p").agg(*counts)
        histogram = checkpointed(histogram)
        up = histogram.withColumn("d", F.explode(F.sequence(F.lit(start), F.lit(bits)))).withColumn("q", F.call_function("shiftright", F.col("p"), F.lit(bits) - F.col("d")))
        fits = (F.col("bytes") <= limit) | (F.col("low") == F.col("high"))
        buckets = up.groupBy("d", "q").agg(*counts).where(fits).select("d", "q", F.struct(F.col("d").alias("depth"), "bytes", "docs").alias("bucket"))
        entries = up.join(buckets, ["d", "q"], "left").groupBy("p").agg(F.min("bucket").alias("bucket"))  # the shortest prefix that fits
        entries = checkpointed(entries)
        out.append((bits, entries.where("bucket is not null").select("p", "bucket")))
        over = entries.where("bucket is null").select("p")
        if not over.take(1):
            return out
        sizes = sizes.withColumn("p", _prefix(bits)).join(over, "p", "left_semi").drop("p")
        start, bits = bits + 1, min(BITS, bits + 2 * SPARE)


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """rows (x, n_bytes, h) with shard, depth, page, shard_bytes and shard_docs."""
    sizes = stored(rows.select("h", "n_bytes"), "sizes")  # two numbers a document; text is not measured again
    levels, found = directory(sizes, limit), rows
    for k, (bits, entries) in enumerate(levels):
        found = found.withColumn("p", _prefix(bits)).join(entries.withColumnRenamed("bucket", f"b{k}"), "p", "left").drop("p")
    bucket = F.coalesce(*(F.col(f"b{k}") for k in range(len(levels))))
    found = found.select("x", "n_bytes", "h", bucket.alias("bucket")).select("x", "n_bytes", "h", F.col("bucket.depth").cast("long").alias("depth"), F.col("bucket.bytes").alias("shard_bytes"), F.col("bucket.docs").alias("shard_docs"))
    found = found.withColumn("shard", F.substring(F.lpad(F.bin("h"), BITS, "0"), F.lit(1), F.col("depth").cast("int"))).drop("h")
    columns = ["x", "n_bytes", "shard", "depth", "page", "shard_bytes", "shard_docs"]
    paged = (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1)
    within = found.where(~paged).withColumn("page", F.lit(0).cast("long")).select(columns)
    if not any(e.where((F.col("bucket.bytes") > limit) & (F.col("bucket.docs") > 1)).take(1) for _, e in levels):
        return within
    return within.union(_pages(found.where(paged), limit).select(columns))


def _measured(df: DataFrame, x: Column, id_col: str, text_col: str) -> DataFrame:
    return df.select(x.alias("x"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"), key_hash(F.col(id_col)).alias("h"))


def assign(df: DataFrame, limit: int = 8 * 2**20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: the id, n_bytes (UTF-8), shard (the prefix bits as text; the root is ""), depth, page (0, or the overflow page),
    shard_bytes and shard_docs of that shard and page.

    A null text has 0 bytes. A null id hashes like an empty one. Every shard page holds at most `limit` bytes, unless one document alone has more.
    Rows that repeat an id share a shard while they fit it and fill pages of it beyond. An empty table gives an empty result. Other columns are not read."""
    return _placed(_measured(df, F.col(id_col), id_col, text_col), limit).withColumnRenamed("x", id_col)


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of shards that no bit splits: every task fills pages of its own from its rows, so a shard of any number of rows is no single task's.
    A page closes before the document that would start beyond half the limit, so a page holds at most the limit or one larger document."""
    made = stored(rows.withColumns({"part": F.spark_partition_id().cast("long"), "row": F.monotonically_increasing_id()}), "overflow")
    w = Window.partitionBy("shard", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    half = max(1, limit // 2)
    # Documents over half the limit take a page each; the others share pages of half the limit, by where they start.
    large = F.col("n_bytes") > half
    before = F.coalesce(F.sum(F.when(large, 0).otherwise(F.col("n_bytes"))).over(w), F.lit(0))
    own = F.coalesce(F.sum(F.when(large, 1).otherwise(0)).over(w), F.lit(0))
    local = made.withColumn("k", F.when(large, 2 * own + 1).otherwise(2 * F.floor(before / half)).cast("long"))
    pages = local.groupBy("shard", "part", "k").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
    numbered = pages.withColumn("i", F.row_number().over(Window.partitionBy("shard", "part").orderBy("k")) - 1)
    base = running_base(numbered.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")), "shard", "part", "n", "base")
    named = numbered.join(base, ["shard", "part"]).select("shard", "part", "k", (F.col("base") + F.col("i")).cast("long").alias("page"), F.col("bytes").alias("page_bytes"), F.col("docs").alias("page_docs"))
    return local.join(named, ["shard", "part", "k"]).select("x", "n_bytes", "shard", "depth", "page", F.col("page_bytes").alias("shard_bytes"), F.col("page_docs").alias("shard_docs"))


def write_shards(df: DataFrame, path: str, limit: int = 8 * 2**20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """df's rows, each once and with all columns, as one Parquet folder a shard page (`_shard=s<prefix>.<page>`). Null and repeated ids are rows like others. A
    row finds its shard by its own hash, so nothing is joined by id. df must not have a column `_shard`."""
    if "_shard" in df.columns:
        raise ValueError("df has a column _shard")
    rows = _placed(_measured(df, F.struct(*(F.col(f"`{c}`") for c in df.columns)), id_col, text_col), limit)
    rows.select("x.*", F.concat(F.lit("s"), F.col("shard"), F.lit("."), F.col("page")).alias("_shard")).repartition("_shard").write.partitionBy("_shard").parquet(path)
