"""Queries by name, and the SQL that gives the same rows.

Each query commits a short history made of the given tables to a versioned table in shared storage and reads it back as a changelog. Data files are
written in key order, so that positions can be told from keys."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators import changelog as C
from sedimenta.operators.changes import changes, snapshot_rows
from sedimenta.operators.temporal import temporal_join
from sedimenta.sources.iceberg import IcebergTable, publish
from sedimenta.sources.log import VersionedTable
from sedimenta.sources.model import Snapshot
from sedimenta.sources.places import shared_path

ORDERS = ["o_orderkey", "o_custkey", "o_totalprice"]
CUSTOMERS = ["c_custkey", "c_nationkey", "c_mktsegment"]
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(spark: SparkSession, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> VersionedTable:
    return VersionedTable.create(shared_path(spark, "warehouse"), "db.t", schema, partition_by)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*ORDERS)


def appended(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, list[Snapshot]]:
    """orders in three snapshots by o_orderkey % 3; o_orderkey // 3 is the position."""
    df = orders(spark, sf_dir)
    t = fresh(spark, df.schema)
    return t, [t.append(df.where(F.col("o_orderkey") % 3 == k), ["o_orderkey"], millis=1_700_000_000_000 + 1000 * k) for k in range(3)]


def whole(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, Snapshot]:
    df = orders(spark, sf_dir)
    t = fresh(spark, df.schema)
    return t, t.append(df, ["o_orderkey"], millis=1_700_000_000_000)


def rows_of(s: Snapshot) -> int:
    return s.added[0].rows


def read(spark: SparkSession, t: VersionedTable | IcebergTable, *metadata: str, **more: object) -> DataFrame:
    return changes(spark, t, metadata=metadata or ("_change_type", "_change_ordinal"), **more)


_O = "o_orderkey, o_custkey, o_totalprice"
_APPEND = f"SELECT {_O}, 'INSERT' AS _change_type, CAST(o_orderkey % 3 AS INTEGER) AS _change_ordinal FROM orders"
_ALL = f"SELECT {_O}, 'INSERT' AS _change_type, 0::INTEGER AS _change_ordinal FROM orders"


def _deleted(where: str, ordinal: int) -> str:
    return f" UNION ALL SELECT {_O}, 'DELETE', {ordinal}::INTEGER FROM orders WHERE {where}"


@query(_APPEND)
def cdc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, appended(spark, sf_dir)[0])


@query(_ALL + _deleted("o_orderkey % 7 = 0", 1))
def cdc_position_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = whole(spark, sf_dir)
    f = s.added[0]
    t.commit(deletes=[t.position_delete({f.path: range(0, f.rows, 7)}, referenced=f.path)])
    return read(spark, t)


@query(_ALL + _deleted("o_orderkey % 7 = 0", 1))
def cdc_deletion_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = whole(spark, sf_dir)
    t.commit(deletes=[t.deletion_vector(s.added[0], range(0, rows_of(s), 7))])
    return read(spark, t)


@query(_APPEND + _deleted("o_orderkey % 3 < 2 AND (o_orderkey // 3) % 5 = 0", 3))
def cdc_global_position_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = appended(spark, sf_dir)
    t.commit(deletes=[t.position_delete({x.added[0].path: range(0, rows_of(x), 5) for x in s[:2]})])
    return read(spark, t)


@query(f"SELECT {_O}, 'INSERT' AS _change_type, 0::INTEGER AS _change_ordinal FROM orders WHERE o_orderkey % 4 <> 0")
def cdc_born_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = orders(spark, sf_dir)
    t = fresh(spark, df.schema)
    f = t.write_data(df, ["o_orderkey"])[0]
    t.commit([f], deletes=[t.deletion_vector(f, range(0, f.rows, 4))])
    return read(spark, t)


@query(_ALL + _deleted("o_custkey BETWEEN 0 AND 49", 1))
def cdc_equality_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, _ = whole(spark, sf_dir)
    t.commit(deletes=[t.equality_delete(pa.table({"o_custkey": pa.array(range(50), pa.int64())}))])
    return read(spark, t)


@query(
    "WITH e AS (SELECT event_id, event_type, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS who FROM events), k(event_type, who) AS (VALUES ('view', NULL), ('click', 7), ('error', 235)) "
    "SELECT e.*, 'INSERT' AS _change_type, 0::INTEGER AS _change_ordinal FROM e UNION ALL SELECT e.*, 'DELETE', 1::INTEGER FROM e WHERE EXISTS (SELECT 1 FROM k WHERE k.event_type = e.event_type AND k.who IS NOT DISTINCT FROM e.who)"
)
def cdc_equality_multi_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("who"))
    t = fresh(spark, df.schema)
    t.append(df, ["event_id"])
    t.commit(deletes=[t.equality_delete(pa.table({"event_type": ["view", "click", "error"], "who": pa.array([None, 7, 235], pa.int64())}))])
    return read(spark, t)


@query("SELECT o_orderkey, 'INSERT' AS kind FROM orders UNION ALL SELECT o_orderkey, 'DELETE' FROM orders WHERE o_custkey BETWEEN 0 AND 49")
def cdc_equality_projected_away(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.functions.schema import metadata_field

    t, _ = whole(spark, sf_dir)
    t.commit(deletes=[t.equality_delete(pa.table({"o_custkey": pa.array(range(50), pa.int64())}))])
    return changes(spark, t, columns=T.StructType([T.StructField("o_orderkey", T.LongType()), metadata_field("kind", "_change_type")]))


_CUST = "SELECT c_custkey, c_nationkey, c_mktsegment, 'INSERT' AS _change_type FROM customer"


@query(_CUST + " UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment, 'DELETE' FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey < 10")
def cdc_partition_scoped_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(*CUSTOMERS)
    t = fresh(spark, df.schema, ("c_mktsegment",))
    t.append(df, ["c_custkey"])
    t.commit(deletes=[t.equality_delete(pa.table({"c_nationkey": pa.array(range(10), pa.int32())}), partition=("MACHINERY",))])
    return read(spark, t, "_change_type")


@query(_CUST + " WHERE c_mktsegment = 'MACHINERY'")
def cdc_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(*CUSTOMERS)
    t = fresh(spark, df.schema, ("c_mktsegment",))
    t.append(df, ["c_custkey"])
    return read(spark, t, "_change_type", partition={"c_mktsegment": "MACHINERY"})


@query(_APPEND + _deleted("o_orderkey % 3 = 0", 3) + f" UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 'INSERT', 3::INTEGER FROM orders WHERE o_orderkey % 6 = 0")
def cdc_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = appended(spark, sf_dir)
    new = t.write_data(orders(spark, sf_dir).where("o_orderkey % 6 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    t.commit(new, removed=[s[0].added[0].path])
    return read(spark, t)


@query(_ALL + _deleted("o_orderkey % 7 = 0", 1) + _deleted("o_orderkey % 7 <> 0", 2))
def cdc_removed_after_dv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = whole(spark, sf_dir)
    t.commit(deletes=[t.deletion_vector(s.added[0], range(0, rows_of(s), 7))])
    t.commit(removed=[s.added[0].path])
    return read(spark, t)


@query(_ALL + _deleted("o_orderkey % 6 = 0", 1) + _deleted("o_orderkey % 6 <> 0 AND o_orderkey % 3 = 0", 2))
def cdc_cumulative_dv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = whole(spark, sf_dir)
    for step in (6, 3):
        t.commit(deletes=[t.deletion_vector(s.added[0], range(0, rows_of(s), step))])
    return read(spark, t)


@query(_APPEND)
def cdc_compaction_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = appended(spark, sf_dir)
    t.commit(t.write_data(orders(spark, sf_dir), ["o_orderkey"]), removed=[x.added[0].path for x in s], operation="replace")
    return read(spark, t)


def upserts(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Every tenth order gets a new price, by an equality delete and an insert in one snapshot."""
    t, s = whole(spark, sf_dir)
    new = t.write_data(orders(spark, sf_dir).where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2), ["o_orderkey"])
    t.commit(new, deletes=[t.equality_delete(pa.table({"o_orderkey": pa.array(range(0, rows_of(s), 10), pa.int64())}))])
    return t


_UPSERTS = _ALL + _deleted("o_orderkey % 10 = 0", 1) + " UNION ALL SELECT o_orderkey, o_custkey, o_totalprice * 2, 'INSERT', 1::INTEGER FROM orders WHERE o_orderkey % 10 = 0"


@query(_UPSERTS)
def cdc_upsert_same_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, upserts(spark, sf_dir))


@query("SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value, 'INSERT' AS _change_type FROM events")
def cdc_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    t = fresh(spark, df.drop("value").schema)
    t.append(df.where("event_id % 2 = 0").drop("value"), ["event_id"])
    t.evolve(df.schema)
    t.append(df.where("event_id % 2 = 1"), ["event_id"])
    return read(spark, t, "_change_type")


@query(
    "WITH o AS (SELECT o_orderkey, o_orderkey % 3 AS k, o_orderkey // 3 AS pos, (SELECT count(*) FROM orders x WHERE x.o_orderkey % 3 = 0) AS n0, (SELECT count(*) FROM orders x WHERE x.o_orderkey % 3 = 1) AS n1 FROM orders) "
    "SELECT o_orderkey, pos AS _pos, CAST(pos + CASE k WHEN 0 THEN 0 WHEN 1 THEN n0 ELSE n0 + n1 END AS BIGINT) AS _row_id, CAST(k + 1 AS BIGINT) AS _last_updated_sequence_number, CAST(k AS INTEGER) AS _change_ordinal, 'INSERT' AS _change_type, 0::INTEGER AS _spec_id, "
    "CAST(k + 1 AS BIGINT) AS _commit_snapshot_id, 1700000000 + k AS committed FROM o"
)
def cdc_metadata_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("_pos", "_row_id", "_last_updated_sequence_number", "_change_ordinal", "_change_type", "_spec_id", "_commit_snapshot_id", "_commit_timestamp")
    return read(spark, appended(spark, sf_dir)[0], *names).select("o_orderkey", *names[:-1], F.unix_seconds("_commit_timestamp").alias("committed"))


@query(f"SELECT {_O}, 'INSERT' AS _change_type, CAST(o_orderkey % 3 - 1 AS INTEGER) AS _change_ordinal FROM orders WHERE o_orderkey % 3 > 0")
def cdc_incremental_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = appended(spark, sf_dir)
    return read(spark, t, start=s[0].id)


@query(_ALL + " LIMIT 0")
def cdc_latest_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, appended(spark, sf_dir)[0], startup="latest")


_FINAL = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders"


@query(_FINAL)
def cdc_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.materialize(read(spark, upserts(spark, sf_dir)), ORDERS)


@query(_FINAL)
def cdc_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.latest(read(spark, upserts(spark, sf_dir)), ["o_orderkey"], ORDERS, ["_change_ordinal"])


@query(_FINAL)
def cdc_table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_rows(spark, upserts(spark, sf_dir))


@query(
    f"SELECT {_O}, 'INSERT' AS _change_type FROM orders UNION ALL SELECT {_O}, 'UPDATE_BEFORE' FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey, o_custkey, o_totalprice * 2, 'UPDATE_AFTER' FROM orders WHERE o_orderkey % 10 = 0"
)
def cdc_update_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.pair_updates(read(spark, upserts(spark, sf_dir), "_change_type", "_commit_snapshot_id"), ["o_orderkey"]).drop("_commit_snapshot_id")


@query(f"SELECT o_custkey, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, round(avg(cents), 6) AS mean, max(cents) AS most FROM (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM ({_FINAL})) GROUP BY o_custkey")
def cdc_signed_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed sums over the changelog; the maximum over the folded table, since a maximum can't be taken back."""
    log = read(spark, upserts(spark, sf_dir)).withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    sums = log.groupBy("o_custkey").agg(C.signed_count().alias("n"), C.signed_sum("cents").alias("total"), F.round(C.signed_avg("cents"), 6).alias("mean")).where("n > 0")
    most = C.materialize(log, ["o_orderkey", "o_custkey", "cents"]).groupBy("o_custkey").agg(F.max("cents").alias("most"))
    return sums.join(most, "o_custkey")


@query(f"SELECT _change_ordinal, _change_type, count(*) AS n FROM ({_UPSERTS}) GROUP BY ALL")
def cdc_change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.change_summary(read(spark, upserts(spark, sf_dir)), "_change_ordinal")


_ASOF = "SELECT f.event_id, f.user_id, f.ts, v.value AS version_value FROM (SELECT * FROM events WHERE event_type = 'purchase') f ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'signup') v ON f.user_id = v.user_id AND f.ts >= v.ts"


def versions(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Signups (and other kinds) of the users, as a changelog of a versioned table."""
    df = table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds)).select("user_id", "ts", "value", "event_type")
    t = fresh(spark, df.schema)
    t.append(df, ["ts"])
    return read(spark, t, "_change_ordinal")


@query(_ASOF)
def temporal_join_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    v = versions(spark, sf_dir, "signup").select("user_id", F.col("ts").alias("since"), F.col("value").alias("version_value"))
    return temporal_join(facts, v, "user_id", "ts", "since").select("event_id", "user_id", "ts", "version_value")


@query(
    "SELECT f.event_id, CASE WHEN v.event_type = 'error' THEN NULL ELSE v.value END AS version_value, coalesce(v.event_type <> 'error', false) AS matched FROM (SELECT * FROM events WHERE event_type = 'purchase') f "
    "ASOF LEFT JOIN (SELECT user_id, ts, value, event_type FROM events WHERE event_type IN ('signup', 'error')) v ON f.user_id = v.user_id AND f.ts >= v.ts"
)
def temporal_join_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors stand for deleted versions: they are versions like others and are masked after the join."""
    facts = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    v = versions(spark, sf_dir, "signup", "error").select("user_id", F.col("ts").alias("since"), "value", "event_type")
    found = temporal_join(facts, v, "user_id", "ts", "since")
    gone = F.col("event_type") == "error"
    return found.select("event_id", F.when(~F.coalesce(gone, F.lit(False)), F.col("value")).alias("version_value"), F.coalesce(~gone, F.lit(False)).alias("matched"))


def _streamed(spark: SparkSession, t: VersionedTable | IcebergTable, times: int = 1, between: Callable[[], None] | None = None, **options: str) -> DataFrame:
    """The table's stream, run to its present end into Parquet, `times` times with the same checkpoint."""
    from sedimenta.streaming import source

    out, mark = shared_path(spark, "stream"), shared_path(spark, "stream-state")
    given = {"catalog-impl": "filesystem", "warehouse": t.root.removesuffix("/db/t"), "table": "db.t", "bounded": "true"} | {k.replace("_", "-"): v for k, v in options.items()}
    schema = T.StructType([*t.load()["schema"].fields, T.StructField("_change_type", T.StringType()), T.StructField("_file", T.StringType()), T.StructField("_pos", T.LongType())])
    for k in range(times):
        if k and between:
            between()
        df = source.read_stream(spark, given, T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
        source.write_stream(df, given).format("parquet").option("path", out).option("checkpointLocation", mark).start().awaitTermination()
    return spark.read.parquet(out)


_TYPED = f"SELECT {_O}, _change_type FROM ({_UPSERTS})"


@query(_TYPED)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, upserts(spark, sf_dir)).select(*ORDERS, "_change_type")


@query(f"SELECT {_O}, _change_type FROM ({_ALL + _deleted('o_orderkey % 7 = 0', 1)})")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read, stop, commit a delete, and go on from the checkpoint."""
    t, s = whole(spark, sf_dir)
    later = lambda: t.commit(deletes=[t.deletion_vector(s.added[0], range(0, rows_of(s), 7))])
    return _streamed(spark, t, 2, later).select(*ORDERS, "_change_type")


@query("SELECT 3::BIGINT AS files, 0::BIGINT AS split_files")
def file_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose rows, inserts and deletes, reach more than one task: none."""
    t, s = appended(spark, sf_dir)
    t.commit(deletes=[t.deletion_vector(s[0].added[0], range(0, 100))])
    log = read(spark, t, "_change_type", "_file", mode="file-affinity").withColumn("task", F.spark_partition_id())
    return log.groupBy("_file").agg(F.countDistinct("task").alias("tasks")).agg(F.count(F.lit(1)).alias("files"), F.count(F.when(F.col("tasks") > 1, 1)).alias("split_files"))


@query(f"SELECT {_O}, CAST(row_number() OVER (ORDER BY chain, seq, pos) - 1 AS BIGINT) AS place FROM (SELECT {_O}, o_orderkey % 3 AS chain, 0 AS seq, o_orderkey // 3 AS pos FROM orders UNION ALL SELECT {_O}, 3, 0, o_orderkey // 3 FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey // 3 < 100)")
def cdc_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of the rows in an ordered read: snapshot, then operation, then position. The number of a row is taken after the sort, partition by partition."""
    t, s = appended(spark, sf_dir)
    t.commit(deletes=[t.deletion_vector(s[0].added[0], range(0, 100))])
    log = read(spark, t, mode="ordered").drop("_change_type", "_change_ordinal").withColumn("row", F.monotonically_increasing_id()).checkpoint()
    log = log.withColumns({"part": F.shiftright("row", 33), "within": F.col("row").bitwiseAND(F.lit(2**33 - 1))})
    sizes = log.groupBy("part").count().select(F.col("part").alias("before"), F.col("count").alias("n"))  # a row for each task
    ends = log.select("part").distinct().join(sizes, F.col("before") < F.col("part"), "left").groupBy("part").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("base"))
    return log.join(ends, "part").select(*ORDERS, (F.col("base") + F.col("within")).alias("place"))


def published(spark: SparkSession, t: VersionedTable) -> IcebergTable:
    return publish(t, shared_path(spark, "warehouse") + "/db/t")


@query(_UPSERTS + _deleted("o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0", 2) + _deleted("o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0", 3) + " UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 'INSERT', 3::INTEGER FROM orders WHERE o_orderkey % 6 = 0")
def iceberg_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history in the Iceberg format: an append, an upsert by an equality delete, a deletion vector, and an overwrite of the first file."""
    t = upserts(spark, sf_dir)
    first = next(iter(t.load()["snapshots"].values())).added[0]
    t.commit(deletes=[t.deletion_vector(first, range(0, first.rows, 7))])
    t.commit(t.write_data(orders(spark, sf_dir).where("o_orderkey % 6 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"]), removed=[first.path])
    return read(spark, published(spark, t))


@query(_CUST + " UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment, 'DELETE' FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey < 10")
def iceberg_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(*CUSTOMERS)
    t = fresh(spark, df.schema, ("c_mktsegment",))
    t.append(df, ["c_custkey"])
    t.commit(deletes=[t.equality_delete(pa.table({"c_nationkey": pa.array(range(10), pa.int32())}), partition=("MACHINERY",))])
    return read(spark, published(spark, t), "_change_type")


@query(f"SELECT {_O}, 'DELETE' AS _change_type, 0::INTEGER AS _change_ordinal FROM orders WHERE o_orderkey % 3 = 0 AND (o_orderkey // 3) % 5 = 0")
def iceberg_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are deleted from a file whose snapshot has expired: the oldest manifests still list it."""
    t, s = appended(spark, sf_dir)
    t.commit(deletes=[t.deletion_vector(s[0].added[0], range(0, rows_of(s[0]), 5))])
    t.expire(s[2].id)
    return read(spark, published(spark, t), start=s[2].id)


@query(f"SELECT {_O}, _change_type FROM ({_UPSERTS})")
def iceberg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, published(spark, upserts(spark, sf_dir)), catalog_impl="hadoop").select(*ORDERS, "_change_type")


@query(f"SELECT {_O}, _change_type FROM ({_UPSERTS})")
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog as a SQL object: CREATE TEMPORARY VIEW with declared columns and options."""
    from sedimenta.streaming import source

    source.register(spark)
    t = upserts(spark, sf_dir)
    name = "cdc_" + t.root.removesuffix("/db/t").rsplit("-", 1)[-1]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, _change_type STRING) USING cdc OPTIONS ('catalog-impl' 'filesystem', 'warehouse' '{t.root.removesuffix('/db/t')}', 'table' 'db.t', 'bounded' 'true')")
    return spark.sql(f"SELECT o_orderkey, o_custkey, o_totalprice, _change_type FROM {name}")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
