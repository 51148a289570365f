"""What folds a changelog: Spark has no retraction, so a deleted row counts minus one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERT, DELETE, BEFORE, AFTER = "INSERT", "DELETE", "UPDATE_BEFORE", "UPDATE_AFTER"


def sign(kind: str = "_change_type") -> Column:
    return F.when(F.col(kind).isin(INSERT, AFTER), F.lit(1)).otherwise(F.lit(-1))


def materialize(changes: DataFrame, columns: list[str]) -> DataFrame:
    """The table after the changes, as a multiset: rows (of these columns) as often as they were inserted more than deleted. Partial sums before the shuffle."""
    folded = changes.groupBy(*columns).agg(F.sum(sign()).alias("_n")).where("_n > 0")
    return folded.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))).alias("_one")).drop("_one")


def latest(changes: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """With keys: the last change of each key by `order` (deletes come before inserts of the same place), if it is no delete."""
    place = F.struct(*order, sign().alias("_sign"))
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(sign().alias("_sign"), *columns), place).alias("_last"))
    return last.where("_last._sign > 0").select(*(F.col(f"_last.{c}").alias(c) for c in columns))


def pair_updates(changes: DataFrame, keys: list[str], snapshot: str = "_commit_snapshot_id") -> DataFrame:
    """A delete and an insert of the same key in one snapshot become UPDATE_BEFORE and UPDATE_AFTER."""
    w = Window.partitionBy(snapshot, *keys)
    both = (F.max((F.col("_change_type") == DELETE).cast("int")).over(w) + F.max((F.col("_change_type") == INSERT).cast("int")).over(w)) == 2
    kind = F.when(both & (F.col("_change_type") == DELETE), BEFORE).when(both & (F.col("_change_type") == INSERT), AFTER).otherwise(F.col("_change_type"))
    return changes.withColumn("_change_type", kind)


def signed_count() -> Column:
    return F.sum(sign())


def signed_sum(column: str) -> Column:
    return F.sum(sign() * F.col(column))


def signed_avg(column: str) -> Column:
    """Mean of the rows that are left; nulls do not count."""
    n = F.sum(F.when(F.col(column).isNotNull(), sign()).otherwise(0))
    return F.when(n != 0, signed_sum(column) / n)


def change_summary(changes: DataFrame, by: str = "_commit_snapshot_id") -> DataFrame:
    return changes.groupBy(by, "_change_type").agg(F.count(F.lit(1)).alias("n"))
