"""Connected components of a links table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """links (a, b) of ids -> (id, component): the smallest id reachable, for every id in a link. Ids in no link are not in the result.

    Nothing but counts and one checksum comes to the driver. A node with very many links costs one row for each: minima are pre-aggregated
    before the shuffle, and the join back is a plain join, whose hot side Spark splits. Lineage is cut by a reliable checkpoint each round."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = checkpointed(edges)
    seen = None
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every larger neighbour of u links to the smallest of u and its neighbours.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours link to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        edges = checkpointed(joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct().toDF("id", "component"))
        seen = state
    raise RuntimeError(f"components: not settled after {rounds} rounds")
