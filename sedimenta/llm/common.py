"""What several operators share: places in shared storage, column hygiene, and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.sources.places import shared_dir, shared_path

#: Rows of one Arrow batch that leaves a Python worker.
OUT_ROWS = 4096


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors, and is read by column."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """df as a table in the shared folder, in buckets of this column: later joins on it find its rows where they are, and only the other side moves."""
    spark = df.sparkSession
    path, n = shared_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(n, key).write.option("compression", "zstd").option("path", path).bucketBy(n, key).saveAsTable(table)
    return spark.table(table)


def checkpointed(df: DataFrame) -> DataFrame:
    """For small tables of loops: a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches from tuples, at most `size` rows each."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*kept), schema, strict=True)], schema=schema)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*kept), schema, strict=True)], schema=schema)


def map_rows(df: DataFrame, make: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema) -> DataFrame:
    """df.mapInArrow over tuples: `make` gets all rows of a partition as an iterator and returns the new rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        yield from batches_of(make(rows), schema)

    from pyspark.sql.pandas.types import from_arrow_schema

    return df.mapInArrow(run, from_arrow_schema(schema))


def rows_within_bytes(df: DataFrame, columns: list[str], most_bytes: int, most_rows: int) -> bool:
    """Whether these columns are small enough for the driver and a broadcast, checked by one aggregate."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= most_rows and total <= most_bytes


def running_base(counts: DataFrame, key: str, part: str, n: str, base: str) -> DataFrame:
    """counts (key, part, n): the sum of n over the smaller parts of each key. A group has as many rows as there were tasks, not as there are documents."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, part, F.coalesce(F.sum(n).over(w), F.lit(0)).alias(base))
