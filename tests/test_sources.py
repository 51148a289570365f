"""Avro, catalogs, table metadata in the Iceberg format, shared folders."""

import http.server
import json
import threading
import types

import pytest
import zstandard
from pyspark.sql import types as T
from test_scenarios import frame, log, new

from sedimenta.functions.options import ReadOptions
from sedimenta.operators.changes import changes, snapshot_rows
from sedimenta.sources import avro, catalogs, iceberg, places
from sedimenta.streaming import source

SCHEMA = {
    "type": "record", "name": "r", "fields": [
        {"name": "a", "type": ["null", "long"]}, {"name": "b", "type": "string"}, {"name": "c", "type": {"type": "array", "items": "int"}}, {"name": "d", "type": {"type": "record", "name": "inner", "fields": [{"name": "x", "type": "double"}, {"name": "y", "type": ["null", "bytes"]}]}},
        {"name": "e", "type": "boolean"},
    ],
}
RECORDS = [{"a": k - 50 if k % 3 else None, "b": "é" * k, "c": list(range(k % 4)), "d": {"x": k / 7, "y": b"\0z" if k % 2 else None}, "e": k % 2 == 0} for k in range(100)] + [{"a": 2**62, "b": "", "c": [-(2**31)], "d": {"x": -1.0, "y": None}, "e": True}]


def test_avro_round_trip():
    data = avro.write(RECORDS, SCHEMA, {"k": "v"})
    back, meta = avro.read(data)
    assert back == RECORDS and meta["k"] == "v"
    assert avro.read(avro.write([], SCHEMA))[0] == []
    for bad in (b"", b"Obj\x01", data[:-20], data[:-1] + b"x", b"PAR1" + data):
        with pytest.raises(ValueError):
            avro.read(bad)


@pytest.mark.parametrize("codec", ["null", "snappy", "zstandard"])
def test_avro_codecs(codec):
    import io
    import zlib

    import pyarrow as pa

    body = io.BytesIO()
    for r in RECORDS:
        avro._write(body, r, SCHEMA)
    raw = body.getvalue()
    block = {"null": lambda: raw, "snappy": lambda: pa.compress(raw, "snappy", asbytes=True) + zlib.crc32(raw).to_bytes(4, "big"), "zstandard": lambda: zstandard.compress(raw)}[codec]()
    text = lambda x: avro._long(len(x)) + x
    head = avro.MAGIC + avro._long(2) + text(b"avro.schema") + text(json.dumps(SCHEMA).encode()) + text(b"avro.codec") + text(codec.encode()) + avro._long(0) + b"s" * 16
    assert avro.read(head + avro._long(len(RECORDS)) + text(block) + b"s" * 16)[0] == RECORDS


def history(spark):
    t = new()
    f = t.append(frame(spark, (1, "a"), (2, "b"), (3, "c")), ["id"]).added[0]
    t.commit(deletes=[t.deletion_vector(f, [0])])
    t.append(frame(spark, (4, "d")))
    return t


def test_the_same_changes_in_both_formats(spark):
    t = history(spark)
    made = iceberg.publish(t, t.root + "-published")
    assert log(spark, made) == log(spark, t)
    assert sorted(map(tuple, snapshot_rows(spark, made).collect())) == sorted(map(tuple, snapshot_rows(spark, t).collect()))
    one, other = made.load(), t.load()
    assert {i: (s.parent, s.sequence, s.millis, s.operation, s.added, s.removed) for i, s in one["snapshots"].items()} == {i: (s.parent, s.sequence, s.millis, s.operation, s.added, s.removed) for i, s in other["snapshots"].items()}
    t.append(frame(spark, (5, "e")))  # a later version of the metadata is seen by the same object
    iceberg.publish(t, t.root + "-published")
    assert log(spark, made) == log(spark, t)


def test_types():
    struct = {"type": "struct", "fields": [
        {"id": 1, "name": "a", "required": True, "type": "decimal(9, 2)"}, {"id": 2, "name": "b", "required": False, "type": {"type": "list", "element-id": 3, "element": "timestamptz", "element-required": False}},
        {"id": 4, "name": "c", "required": False, "type": {"type": "map", "key-id": 5, "key": "string", "value-id": 6, "value": "fixed[4]", "value-required": True}}, {"id": 7, "name": "d", "required": False, "type": "timestamp"},
    ]}
    assert iceberg.struct_type(struct).simpleString() == "struct<a:decimal(9,2),b:array<timestamp>,c:map<string,binary>,d:timestamp_ntz>"
    with pytest.raises(Exception, match="column type"):
        iceberg.spark_type("timestamp_ns")


def options(t, **more):
    return ReadOptions.parse({"catalog-impl": "hadoop", "warehouse": t.root.removesuffix("/db/t"), "table": "db.t"} | more)


def test_catalogs(spark, monkeypatch):
    t = history(spark)
    where = t.root.removesuffix("/db/t") + "-warehouse"
    iceberg.publish(t, where + "/db/t")
    base = {"catalog-impl": "hadoop", "warehouse": where, "table": "db.t"}
    assert log(spark, catalogs.load(ReadOptions.parse(base))) == log(spark, t)
    with pytest.raises(ValueError, match="catalog-impl"):
        catalogs.load(ReadOptions.parse(base | {"catalog-impl": "x"}))
    with pytest.raises(ValueError, match="catalog.uri"):
        catalogs.load(ReadOptions.parse(base | {"catalog.uri": "http://x"}))
    given = {}

    class Own:
        def __init__(self, warehouse, properties):
            given.update(properties, warehouse=warehouse)

        def table(self, name):
            return t

    module = types.ModuleType("own_catalog")
    module.Own = Own
    monkeypatch.setitem(__import__("sys").modules, "own_catalog", module)
    assert catalogs.load(ReadOptions.parse(base | {"catalog-impl": "own_catalog:Own", "catalog.uri": "u", "catalog.s3.endpoint": "e", "catalog.region": "r"})) is t
    assert given == {"uri": "u", "s3.endpoint": "e", "client.region": "r", "warehouse": where}


def test_rest_catalog(spark):
    t = history(spark)
    made = iceberg.publish(t, t.root + "-rest")
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            asked.append((self.path, self.headers["Authorization"]))
            body = json.dumps({"metadata-location": "x", "metadata": made._metadata()}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        o = {"catalog-impl": "rest", "warehouse": "", "table": "db.t", "catalog.uri": f"http://127.0.0.1:{server.server_port}", "catalog.token": "k", "bounded": "true"} | {"warehouse": "w"}
        assert log(spark, catalogs.load(ReadOptions.parse(o))) == log(spark, t)
        source.register(spark)
        assert sorted(map(tuple, spark.read.format("cdc").options(**o).load().select("id", "name", "_change_type").collect())) == log(spark, t)
    finally:
        server.shutdown()
    assert set(asked) == {("/v1/namespaces/db/tables/t", "Bearer k")}


def test_expired_history(spark):
    t = new()
    f = t.append(frame(spark, *((k, "a") for k in range(6))), ["id"]).added[0]
    t.commit(deletes=[t.deletion_vector(f, [1])])
    kept = t.append(frame(spark, (10, "b")))
    t.commit(removed=[f.path])
    t.expire(kept.id)
    made = iceberg.publish(t, t.root + "-published")
    rows = changes(spark, made, start=kept.id, metadata=("_change_type",)).collect()
    assert sorted(r["id"] for r in rows) == [0, 2, 3, 4, 5] and {r["_change_type"] for r in rows} == {"DELETE"}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    conf = types.SimpleNamespace(get=lambda k: None)
    fake = types.SimpleNamespace(sparkContext=types.SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://x:7077"), conf=types.SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        places.shared_dir(fake)
    fake.sparkContext.getCheckpointDir = lambda: "hdfs://n/c/"
    assert places.shared_dir(fake) == "hdfs://n/c"


def test_declared_types_of_the_format():
    assert iceberg.format_type(T.DecimalType(5, 1)) == "decimal(5, 1)" and iceberg.format_type(T.LongType()) == "long"
