"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
COMPRESSED = "spark.sql.streaming.stateStore.rocksdb.compression"
MAINTAINED = "spark.sql.streaming.stateStore.maintenanceInterval"
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the transforms rely on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Changelog checkpoints upload only the state rows a micro-batch touched.
    spark.conf.set(CHANGES, "true")
    return spark


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with these settings, and with those of before again at the end."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for checkpoints and derived tables.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. Only a local session without
    that setting gets a temporary folder; on a cluster such a folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="receiptflow-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
