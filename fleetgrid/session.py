"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "fleetgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with runtime re-planning, skew-join splitting and the RocksDB state store."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a single-machine
    session without that setting gets a temporary folder; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="fleetgrid-")


_areas: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten there."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _areas:
        _areas[-1].append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table or folder; nothing happens where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_area(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch tables made inside and deletes them at its end, when results must have been written.

    Without an area they stay in the shared folder until that is cleared.
    """
    _areas.append([])
    try:
        yield
    finally:
        for path in _areas.pop():
            discard(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, so a later retry
    starts from the table and not from the sources.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
