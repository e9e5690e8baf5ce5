"""Upserted tables as parquet files, for lakes and for runs without a database.

Each micro-batch writes its own folder, named after its run and number, so a retried batch replaces its
own files and a write costs the size of the batch, not of the table. A run is what one checkpoint
has done: a job with a new checkpoint takes a ``run`` that is greater. The table is the last row per key
over all runs and batches; ``compact`` folds them into one. Readers see only batches whose writer has
finished (the ``_SUCCESS`` file that Spark writes last).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.operators.latest import latest_per_key
from receiptflow.schemas import Record


def append_batch(path: str, run: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each batch as it is."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")

    return write


def batches(spark: SparkSession, path: str) -> list[str]:
    """The folders of the batches that are complete, from the last compaction on."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/batch=*/_SUCCESS"))
    done = [status.getPath().getParent().toString() for status in found or []]
    place = {p: tuple(int(x.rsplit("=", 1)[1]) for x in p.rsplit("/", 2)[-2:]) for p in done}
    # A compaction is batch -1 of a run, which holds all runs before.
    last = max((run for run, batch in place.values() if batch < 0), default=-1)
    return sorted((p for p in done if place[p][0] >= last), key=place.get)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all complete batches, with ``run`` and ``batch``; none if there is no batch."""
    folders = batches(spark, path)
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    kinds = T.StructType([*kinds.fields, T.StructField("run", T.IntegerType()), T.StructField("batch", T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).option("basePath", path).parquet(*folders)


def upsert(record: Record, path: str, run: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for rows with the record's columns and an ``arrival``."""
    store = append_batch(path, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*record.columns, "arrival").filter(f"{record.key} IS NOT NULL")
        store(latest_per_key(rows, record.key, "arrival"), batch_id)

    return write


def read_changes(spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str) -> DataFrame:
    """The newest state of rows of ``schema`` that batches stored in update mode, each key once per batch."""
    rows = read_batches(spark, path, schema)
    return latest_per_key(rows.withColumn("_order", F.struct("run", "batch")), keys, "_order").drop("run", "batch", "_order")


def stored(spark: SparkSession, path: str, record: Record) -> DataFrame:
    """The last row of each key, with its ``arrival``: the later batch wins, in a batch the later arrival."""
    arrival = next((f.dataType for p in batches(spark, path)[:1] for f in spark.read.parquet(p).schema if f.name == "arrival"), T.LongType())
    schema = T.StructType([*[T.StructField(f.column, f.type) for f in record.fields], T.StructField("arrival", arrival)])
    rows = read_batches(spark, path, schema).withColumn("_order", F.struct("run", "batch", "arrival"))
    return latest_per_key(rows.select(*record.columns, "arrival", "_order"), record.key, "_order").drop("_order")


def read_table(spark: SparkSession, path: str, record: Record, view: str | None = None) -> DataFrame:
    """The table, ready for SQL under ``view`` if one is named."""
    table = stored(spark, path, record).drop("arrival")
    if view:
        table.createOrReplaceTempView(view)
    return table


def compact(spark: SparkSession, path: str, record: Record) -> int:
    """Fold all batches into one, and return the run that a job must take from now on.

    Call it between jobs. The folders before stay as they are; readers leave them out, so they may be
    deleted once no reader is at work on them.
    """
    run = max((int(p.rsplit("/", 2)[-2].split("=")[1]) for p in batches(spark, path)), default=-1) + 1
    append_batch(path, run)(stored(spark, path, record), -1)
    return run
