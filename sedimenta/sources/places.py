"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the folder that setCheckpointDir was given. Where both are unset, a temporary folder if all runs on this machine, as in
    tests, which is then set as the session's; on a cluster it is an error, since executors would not share it."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.checkpoint.dir"):
        return conf.get("spark.checkpoint.dir").rstrip("/")
    own = spark.conf.get("spark.sedimenta.shared.dir", None)
    if own is None and (given := spark.sparkContext.getCheckpointDir()) is not None:
        return given.rstrip("/")
    if own is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="sedimenta-")
        spark.conf.set("spark.sedimenta.shared.dir", own)
        spark.sparkContext.setCheckpointDir(own)
    return own


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Hadoop removes it when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
