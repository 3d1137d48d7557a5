"""Shared scratch storage for cutting lineage and for sinks that are read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_owners: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local session, whose tasks all run on this machine, gets a private
    one where none is set; elsewhere its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="panelwright-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; nothing is reused or overwritten."""
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Remove one path that ``scratch_path`` made; a missing path is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_area(spark: SparkSession) -> Iterator[None]:
    """Deletes every scratch path that was made inside the block when it ends.

    Frames that read these tables must have been written or collected by then.
    """
    _owners.append([])
    try:
        yield
    finally:
        for path in _owners.pop():
            delete(spark, path)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back.

    Cuts the lineage and survives the loss of executors, unlike a cached or
    locally checkpointed frame.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
