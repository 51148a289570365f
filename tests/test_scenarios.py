"""Histories that the queries don't cover: scoping, errors, options, streaming, and a random model."""

import random
import tempfile
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import schema as S
from sedimenta.functions.options import ReadOptions, millis
from sedimenta.operators import changelog
from sedimenta.operators.changes import changes, read_splits, snapshot_rows
from sedimenta.operators.temporal import temporal_join
from sedimenta.plans import planner
from sedimenta.sources import vectors
from sedimenta.sources.log import VersionedTable
from sedimenta.sources.model import DeleteFile, HistoryExpiredError, PlanningError, SchemaError, UnsupportedFormatError
from sedimenta.streaming import source

ID_NAME = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def new(schema=ID_NAME, partition_by=()):
    return VersionedTable.create(tempfile.mkdtemp(prefix="sp ace%20"), "db.t", schema, partition_by)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, name string")


def log(spark, t, *metadata, **more):
    return sorted(tuple(r) for r in changes(spark, t, metadata=metadata or ("_change_type",), **more).collect())


def test_vectors_round_trip():
    rng = np.random.default_rng(1)
    for own in ([], [0], [5, 70_000, 2**33, 2**33 + 1], range(100_000), rng.integers(0, 2**35, 5000)):
        assert vectors.decode(vectors.encode(np.array(list(own), np.int64))).tolist() == sorted({int(x) for x in own})
    with pytest.raises(ValueError, match="checksum"):
        vectors.decode(vectors.encode(np.array([1, 2]))[:-1] + b"\0")


def test_partition_scoped_and_null_keys(spark):
    t = new(T.StructType([T.StructField("id", T.LongType()), T.StructField("region", T.StringType()), T.StructField("name", T.StringType())]), ("region",))
    t.append(spark.createDataFrame([(1, "us", "a"), (1, "eu", "b"), (None, "us", "c")], "id long, region string, name string"), ["id"])
    t.commit(deletes=[t.equality_delete(pa.table({"id": pa.array([1, None], pa.int64())}), partition=("us",))])
    assert [r for r in changes(spark, t, metadata=("_change_type",)).where("_change_type = 'DELETE'").orderBy("name").collect()] == [(1, "us", "a", "DELETE"), (None, "us", "c", "DELETE")]
    assert {r["name"] for r in snapshot_rows(spark, t).collect()} == {"b"}


def test_literal_counts_every_delete(spark):
    t = new()
    f = t.append(frame(spark, (1, "a"), (2, "b"), (3, "c")), ["id"]).added[0]
    t.commit(deletes=[t.deletion_vector(f, [0])])
    t.commit(deletes=[t.deletion_vector(f, [0, 1])])
    t.commit(deletes=[t.equality_delete(pa.table({"id": pa.array([3])})), t.equality_delete(pa.table({"name": ["c"]}))])
    assert changes(spark, t).where("_change_type = 'DELETE'").count() == 3
    assert changes(spark, t, compat="literal").where("_change_type = 'DELETE'").count() == 1 + 2 + 2


def test_start_position_of_a_split(spark):
    t = new()
    t.append(frame(spark, (1, "a"), (2, "b"), (3, "c")), ["id"])
    meta = t.load()
    (split,) = planner.plan(meta).splits
    assert [r["id"] for r in read_splits(spark, meta, [source.from_row(split, 2)], metadata=()).collect()] == [3]


def test_history_guards(spark):
    t = new()
    a = t.append(frame(spark, (1, "a"), (2, "b")), ["id"])
    t.append(frame(spark, (3, "c")))
    t.commit(deletes=[t.deletion_vector(a.added[0], [0])])
    t.expire(2)
    assert [(r[0], r[2]) for r in log(spark, t)] == [(1, "DELETE"), (3, "INSERT")]
    with pytest.raises(HistoryExpiredError, match="no longer in the table's snapshot history"):
        changes(spark, t, start=a.id)
    t.expire(3)
    with pytest.raises(HistoryExpiredError, match="expired"):
        changes(spark, t)
    t.append(frame(spark, (4, "d")))
    assert log(spark, t, start=3) == [(4, "d", "INSERT")]
    t.rollback(3)
    with pytest.raises(HistoryExpiredError):
        changes(spark, t, start=4)


def test_planner_refuses(spark):
    t = new()
    f = t.append(frame(spark, (1, "a"))).added[0]
    t.commit(deletes=[replace(t.deletion_vector(f, [0]), referenced="nowhere")])
    with pytest.raises(PlanningError, match="isn't live"):
        changes(spark, t)
    t = new()
    t.commit([replace(f, format="orc")])
    with pytest.raises(UnsupportedFormatError):
        changes(spark, t)
    t = new()
    t.append(frame(spark, (1, "a")))
    t.commit(deletes=[DeleteFile("x", "equality", keys=("id",), format="avro")])
    with pytest.raises(UnsupportedFormatError):
        changes(spark, t)


def test_same_commit_inserts_survive_and_maintenance(spark):
    t = new()
    t.append(frame(spark, (1, "a")))
    f = t.write_data(frame(spark, (1, "b")))
    t.commit(f, deletes=[t.equality_delete(pa.table({"id": pa.array([1])}))])
    t.commit(t.write_data(frame(spark, (1, "b"))), removed=[f[0].path], summary={"compaction": "true"})
    assert log(spark, t) == [(1, "a", "DELETE"), (1, "a", "INSERT"), (1, "b", "INSERT")]
    assert planner.plan(t.load()).metrics["maintenanceSkipped"] == 1


def test_declared_schema(spark):
    t = new()
    t.append(frame(spark, (1, "a")))
    ok = T.StructType([S.metadata_field("n", "_last_updated_sequence_number"), T.StructField("name", T.StringType(), False), T.StructField("_pos", T.LongType())])
    assert [tuple(r) for r in changes(spark, t, columns=ok).collect()] == [(1, "a", 0)]
    with pytest.raises(SchemaError, match="has type"):
        changes(spark, t, columns=T.StructType([T.StructField("id", T.StringType())]))
    with pytest.raises(SchemaError, match="neither"):
        changes(spark, t, columns=T.StructType([T.StructField("who", T.StringType())]))


def test_options():
    base = {"catalog-impl": "x", "warehouse": "w", "table": "db.t"}
    o = ReadOptions.parse(base | {"discovery-interval": "5 s", "scan.startup.mode": " Initial ", "split-assignment-mode": "FILE_AFFINITY", "catalog.uri": "u", "catalog.s3.endpoint": "e"})
    assert (o.discovery_millis, o.startup, o.assignment, o.catalog) == (5000, "earliest", "file-affinity", {"s3.endpoint": "e", "uri": "u", "client.region": "us-east-1"})
    assert (o.lateness_millis, o.bounded, millis("2 min")) == (30_000, False, 120_000)
    for bad in ({"discovery-interval": "0 s"}, {"bounded": "maybe"}, {"scan.startup.mode": "middle"}, {"what": "1"}, {"allowed-lateness": "-1 s"}):
        with pytest.raises(ValueError):
            ReadOptions.parse(base | bad)
    with pytest.raises(ValueError, match="missing"):
        ReadOptions.parse({"warehouse": "w"})


def test_key_types(spark):
    """Each type that a key may have, with a null."""
    kinds = {"boolean": "true", "int": "7", "bigint": "7", "float": "1.5", "double": "1.5", "string": "'x'", "binary": "X'00ff'", "decimal(10,2)": "1.25", "date": "DATE'2024-01-02'", "timestamp": "TIMESTAMP'2024-01-02 03:04:05'", "timestamp_ntz": "TIMESTAMP_NTZ'2024-01-02 03:04:05'"}
    columns = [f"CAST({v} AS {k}) AS c{n}" for n, (k, v) in enumerate(kinds.items())]
    nulls = [f"CAST(NULL AS {k}) AS c{n}" for n, k in enumerate(kinds)]
    df = spark.sql(f"SELECT 0L AS id, {', '.join(columns)} UNION ALL SELECT 1L, {', '.join(nulls)}")
    t = new(df.schema)
    t.append(df, ["id"])
    for n in range(len(kinds)):
        t2 = VersionedTable(t.root.removesuffix("/db/t"), "db.t")
        key = df.where("id = 0").select(f"c{n}").toArrow()
        s = t2.commit(deletes=[t2.equality_delete(key)])
        assert [r["id"] for r in changes(spark, t2, start=s.parent).collect()] == ([0] if n == 0 else []), n
        assert [r["id"] for r in changes(spark, t2, start=s.parent, compat="literal").collect()] == [0], n


def test_random_histories_fold_to_the_table(spark):
    """Random commits against a dict: the folded changelog is the table, and the stream gives the same rows as the batch."""
    for seed in range(3):
        rnd, t, model, at, n = random.Random(seed), new(), {}, {}, 0
        for _ in range(7):
            what = rnd.choice(["append", "append", "dv", "equality", "upsert", "remove", "compact"])
            live = [f for f in {p for p, _ in at.values()}]
            if what == "append" or not live:
                rows = [(n + k, rnd.choice("abc")) for k in range(rnd.randint(1, 6))]
                n += len(rows)
                f = t.append(frame(spark, *rows), ["id"]).added[0]
                for k, (i, v) in enumerate(rows):
                    model[i], at[i] = v, (f.path, k)
            elif what == "dv":
                p = rnd.choice(live)
                files = planner.live_state(t.load())
                dead = {k for d in files.deletes[p] if d.content == "dv" for k in _positions(t, d)}
                some = {k for i, (q, k) in at.items() if q == p and rnd.random() < 0.5}
                t.commit(deletes=[t.deletion_vector(files.files[p], dead | some)])
                for i in [i for i, (q, k) in at.items() if q == p and k in some]:
                    model.pop(i), at.pop(i)
            elif what in ("equality", "upsert"):
                v = rnd.choice("abc")
                added, rows = [], []
                if what == "upsert":
                    rows = [(n, v)]
                    n += 1
                    added = t.write_data(frame(spark, *rows))
                t.commit(added, deletes=[t.equality_delete(pa.table({"name": [v]}))])
                for i in [i for i, x in model.items() if x == v]:
                    model.pop(i), at.pop(i)
                for i, x in rows:
                    model[i], at[i] = x, (added[0].path, 0)
            else:
                p = rnd.choice(live)
                own = sorted((k, i) for i, (q, k) in at.items() if q == p)
                if what == "remove":
                    t.commit(removed=[p])
                    for _, i in own:
                        model.pop(i), at.pop(i)
                else:
                    added = t.write_data(frame(spark, *((i, model[i]) for _, i in own)), ["id"])
                    t.commit(added, removed=[p], operation="replace")
                    for k, i in enumerate(sorted(i for _, i in own)):
                        at[i] = (added[0].path, k)
        all_of = changes(spark, t)
        assert sorted(map(tuple, changelog.materialize(all_of, ["id", "name"]).collect())) == sorted(model.items()), seed
        assert sorted(map(tuple, snapshot_rows(spark, t).collect())) == sorted(model.items()), seed
        options = {"catalog-impl": "filesystem", "warehouse": t.root.removesuffix("/db/t"), "table": "db.t", "bounded": "true"}
        source.register(spark)
        read = spark.read.format("cdc").options(**options).load()
        assert sorted(map(tuple, read.select("id", "name", "_change_type").collect())) == log(spark, t), seed


def _positions(t, d):
    with open(d.path, "rb") as f:
        f.seek(d.offset)
        return set(vectors.decode(f.read(d.length)).tolist())


def _options(t, **more):
    return {"catalog-impl": "filesystem", "warehouse": t.root.removesuffix("/db/t"), "table": "db.t", "discovery-interval": "300 ms"} | more


def test_stream_latest_pickup_and_drift(spark):
    t = new()
    f = t.append(frame(spark, (1, "a"), (2, "b")), ["id"]).added[0]
    out, mark = tempfile.mkdtemp(), tempfile.mkdtemp()
    o = _options(t, **{"scan.startup.mode": "latest"})
    start = lambda: source.write_stream(source.read_stream(spark, o), o).format("parquet").option("path", out).option("checkpointLocation", mark).start()
    q = start()
    source.wait_for(q, 60, lambda: q.lastProgress is not None or q.status["isDataAvailable"] is False and q.status["message"].startswith("Waiting"))
    t.append(frame(spark, (3, "c")))
    t.commit(deletes=[t.deletion_vector(f, [0])])
    import os

    seen = lambda: sorted((r["id"], r["_change_type"]) for r in spark.read.parquet(out).collect()) if any(x.endswith(".parquet") for x in os.listdir(out)) else []
    source.wait_for(q, 60, lambda: len(seen()) >= 2)
    assert seen() == [(1, "DELETE"), (3, "INSERT")]
    q.stop()
    t.append(frame(spark, (9, "z")))
    t.rollback(1)  # what the checkpoint has seen is gone
    q = start()
    with pytest.raises(Exception, match="no longer in the table's snapshot history"):
        source.wait_for(q, 60, lambda: not q.isActive and q.exception() is None)


def test_offsets_of_older_checkpoints():
    assert source.offset_of({"snapshot_id": 5}) == (5, True)
    assert source.offset_of(source.offset_json(None, False)) == (None, False)


def test_temporal_join_of_the_order_example(spark):
    at = lambda s: f"2026-01-01 00:{s // 60:02d}:{s % 60:02d}"
    orders = spark.createDataFrame([(1001, 1, at(15)), (1002, 2, at(45)), (1003, 1, at(75)), (-1, -1, at(105))], "order_id long, customer_id long, t string").withColumn("t", F.to_timestamp("t"))
    people = spark.createDataFrame([(1, "alice", "gold", False, at(0)), (2, "bob", "silver", False, at(30)), (1, None, None, True, at(60)), (3, "carol", "bronze", False, at(90))], "customer_id long, name string, tier string, gone boolean, since string").withColumn("since", F.to_timestamp("since"))
    found = temporal_join(orders, people, "customer_id", "t", "since").where("order_id > 0").select("order_id", "name", "tier", F.coalesce(~F.col("gone"), F.lit(False)).alias("matched"))
    assert sorted(map(tuple, found.collect())) == [(1001, "alice", "gold", True), (1002, "bob", "silver", True), (1003, None, None, False)]
