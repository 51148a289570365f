"""The stream source: watermarks, bounded batches, temporal joins, savepoints, durable state."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_scenarios import _options, frame, new

from sedimenta.functions import schema as S
from sedimenta.functions import state_conf
from sedimenta.operators.temporal import temporal_join_stream
from sedimenta.sources.log import VersionedTable
from sedimenta.streaming import source

DECLARED = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("_change_type", T.StringType())])


def run(df, o, mark, out, **more):
    q = source.write_stream(df, o).format("parquet").option("path", out).option("checkpointLocation", mark)
    q = q.start()
    q.awaitTermination()
    return q


def table_of(spark, name, schema, commits):
    """A table with one snapshot for each list of rows, a second apart in commit time."""
    t = VersionedTable.create(tempfile.mkdtemp(), name, schema)
    for k, rows in enumerate(commits):
        t.append(spark.createDataFrame(rows, schema), millis=1_767_225_600_000 + 1000 * k)
    return t


def test_watermark_is_always_there(spark):
    t = new()
    t.append(frame(spark, (1, "a")), ["id"])
    o = _options(t, bounded="true")
    plain = source.read_stream(spark, o, DECLARED)
    assert plain.columns == DECLARED.names and "EventTimeWatermark" in plain._jdf.queryExecution().analyzed().toString()
    named = T.StructType([*DECLARED.fields, S.metadata_field("at", "_commit_timestamp")])
    assert "EventTimeWatermark" in source.read_stream(spark, o, named)._jdf.queryExecution().analyzed().toString()
    with pytest.raises(ValueError, match="watermark-column"):
        source.read_stream(spark, o | {"watermark-column": "nmae"}, DECLARED)
    out = tempfile.mkdtemp()
    run(plain, o, tempfile.mkdtemp(), out)
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, "a", "INSERT")]


def test_windows_over_the_stream_and_late_rows(spark):
    """Counts by minute of the rows' own time; a row behind the watermark is dropped, and counted as such."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType())])
    import datetime as dt

    at = lambda s: dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s)
    t = table_of(spark, "db.t", schema, [[(1, at(0)), (2, at(30)), (3, at(70))], [(4, at(600))]])
    o = {"catalog-impl": "filesystem", "warehouse": t.root.removesuffix("/db/t"), "table": "db.t", "watermark-column": "at", "allowed-lateness": "60 s", "discovery-interval": "100 ms"}
    df = source.read_stream(spark, o, schema).groupBy(F.window("at", "1 minute").alias("w")).agg(F.count("*").alias("n"))
    out, mark = tempfile.mkdtemp(), tempfile.mkdtemp()
    q = source.write_stream(df.select(F.col("w.start").alias("start"), "n"), o).format("parquet").option("path", out).option("checkpointLocation", mark).start()
    rows = lambda: {r["start"].minute: r["n"] for r in spark.read.schema("start timestamp, n long").parquet(out).collect()} if os.path.isdir(f"{out}/_spark_metadata") else {}
    try:
        source.wait_for(q, 60, lambda: len(rows()) >= 2)  # the watermark is at 540
        t.append(spark.createDataFrame([(5, at(10)), (6, at(601))], schema))
        source.wait_for(q, 60, lambda: any(p["numInputRows"] == 2 for p in q.recentProgress))
        t.append(spark.createDataFrame([(7, at(1300))], schema))
        source.wait_for(q, 60, lambda: len(rows()) >= 3)
        late = sum(x["numRowsDroppedByWatermark"] for p in q.recentProgress for x in p["stateOperators"])
    finally:
        q.stop()
    assert rows() == {0: 2, 1: 1, 10: 2} and late == 1


def test_batches_are_bounded_from_the_first_one(spark):
    t = new()
    for k in range(5):
        t.append(frame(spark, (k, "a")))
    r = lambda **more: source.CdcStreamReader(DECLARED, source.ReadOptions.parse(_options(t, **more)))
    for more, want in (({}, [2, 4, 5, 5]), ({"end-snapshot-id": "3"}, [2, 3, 3])):
        reader = r(**{"max-snapshots-per-trigger": "2"} | more)
        at, ends = reader.initialOffset(), []
        for _ in want:
            end = reader.latestOffset()
            assert reader.latestOffset() == end
            reader.partitions(at, end)
            at = end
            ends.append(source.offset_of(end)[0])
        assert ends == want
    three = r(**{"start-snapshot-id": "4", "end-snapshot-id": "5"})
    three.initialOffset()
    assert source.offset_of(three.latestOffset())[0] == 5


def test_affinity_deals_files_to_several_tasks(spark):
    t = new()
    files = [t.append(frame(spark, (k, "a"), (k + 100, "b")), ["id"]).added[0] for k in range(12)]
    for f in files[::3]:
        t.commit(deletes=[t.deletion_vector(f, [0])])
    o = source.ReadOptions.parse(_options(t, parallelism="4", **{"split-assignment-mode": "file-affinity"}))
    parts = source.CdcBatchReader(DECLARED, o).partitions()
    where = {}
    for k, p in enumerate(parts):
        assert [s.chain for s in p.splits] == sorted(s.chain for s in p.splits)
        for s in p.splits:
            where.setdefault(s.path, set()).add(k)
    assert len(parts) > 1 and len(where) == 12 and all(len(x) == 1 for x in where.values())


def test_a_copied_checkpoint_is_a_savepoint(spark):
    t = new()
    t.append(frame(spark, (1, "a")), ["id"])
    o, mark, seen = _options(t, bounded="true"), tempfile.mkdtemp(), []

    def go(where):
        seen.clear()
        keep = lambda df, _: seen.extend(r["id"] for r in df.collect())
        source.write_stream(source.read_stream(spark, o, DECLARED), o).foreachBatch(keep).option("checkpointLocation", where).start().awaitTermination()
        return list(seen)

    assert go(mark) == [1]
    saved = tempfile.mkdtemp() + "/copy"
    shutil.copytree(mark, saved)
    t.append(frame(spark, (2, "b")))
    assert go(mark) == [2] and go(saved) == [2] and go(saved) == []


def test_temporal_join_of_two_streams(spark):
    """Facts wait for the watermark; a deleted version is a version without values; a fact before all versions has none."""
    import datetime as dt

    at = lambda s: dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    facts = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("order_id", T.LongType()), T.StructField("t", T.TimestampType())])
    people = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("tier", T.StringType()), T.StructField("since", T.TimestampType())])
    orders = table_of(spark, "db.t", facts, [[(1, 2**60 + 1, at(15))], [(2, 1002, at(45)), (2, 1000, at(20))], [(1, 1003, at(75))], [(-1, -1, at(500))]])
    versions = table_of(spark, "db.t", people, [[(1, "alice", "gold", at(0))], [(2, "bob", "silver", at(30))], [(1, None, None, at(60))], [(3, "carol", "bronze", at(90)), (-1, None, None, at(500))]])
    state_conf.apply(spark)
    try:
        read = lambda x, s: source.read_stream(spark, {"catalog-impl": "filesystem", "warehouse": x.root.removesuffix("/db/t"), "table": "db.t", "bounded": "true", "watermark-column": s.names[-1]}, s)
        joined = temporal_join_stream(read(orders, facts), read(versions, people), "customer_id", "t", "since", "0 seconds")
        out, mark = tempfile.mkdtemp(), tempfile.mkdtemp()
        q = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(processingTime="200 milliseconds").start()
        rows = lambda: spark.read.schema(joined.schema).parquet(out).where("order_id > 0").collect() if os.path.isdir(f"{out}/_spark_metadata") else []
        try:
            source.wait_for(q, 40, lambda: len(rows()) >= 4)
        except TimeoutError:
            print("PROG", [(p["batchId"], p["numInputRows"], p.get("eventTime"), [(o["numRowsTotal"], o["customMetrics"].get("numExpiredTimers"), o["customMetrics"].get("numRegisteredTimers")) for o in p["stateOperators"]]) for p in q.recentProgress])
        finally:
            q.stop()
    finally:
        state_conf.apply(spark, "hashmap")
    got = sorted((r["order_id"], r["name"], r["tier"]) for r in rows())
    assert got == [(1000, None, None), (1002, "bob", "silver"), (1003, None, None), (2**60 + 1, "alice", "gold")]


def test_durable_state(spark):
    assert "RocksDB" in state_conf.durable_state()["spark.sql.streaming.stateStore.providerClass"] and "HDFSBacked" in state_conf.durable_state("hashmap")["spark.sql.streaming.stateStore.providerClass"]
    with pytest.raises(ValueError):
        state_conf.durable_state("memory")
    t, base = new(), tempfile.mkdtemp()
    t.append(frame(spark, (1, "a")))
    o = _options(t)
    q = state_conf.checkpointed(source.read_stream(spark, o, DECLARED).writeStream.format("memory"), base, "named", "200 milliseconds").start()
    try:
        source.wait_for(q, 60, lambda: spark.table("named").count() == 1)
    finally:
        q.stop()
    assert os.path.isdir(f"{base}/checkpoints/named/offsets")
