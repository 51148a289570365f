"""Settings of durable streaming state."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter


def durable_state(backend: str = "rocksdb") -> dict[str, str]:
    """Session settings: state in RocksDB with changelog checkpoints (small, continuous uploads instead of whole files), or "hashmap" for the in-memory one."""
    if backend not in ("rocksdb", "hashmap"):
        raise ValueError("backend is rocksdb or hashmap")
    provider = "RocksDBStateStoreProvider" if backend == "rocksdb" else "HDFSBackedStateStoreProvider"
    out = {"spark.sql.streaming.stateStore.providerClass": f"org.apache.spark.sql.execution.streaming.state.{provider}", "spark.hadoop.fs.s3a.path.style.access": "true"}
    return out | ({"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"} if backend == "rocksdb" else {})


def apply(spark: SparkSession, backend: str = "rocksdb") -> None:
    for k, v in durable_state(backend).items():
        spark.conf.set(k, v)


def checkpointed(writer: DataStreamWriter, base: str, name: str, interval: str = "10 seconds") -> DataStreamWriter:
    """A query that keeps its offsets, commits and state under base/checkpoints/name, one batch an interval. A copy of that folder is a savepoint."""
    return writer.queryName(name).option("checkpointLocation", f"{base.rstrip('/')}/checkpoints/{name}").trigger(processingTime=interval)
