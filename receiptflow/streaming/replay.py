"""Feeding a stored table through a stream, slice by slice."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from receiptflow.session import CHANGES, COMPRESSED, COUNTED, FREED, MAINTAINED, configured, work_folder
from receiptflow.streaming.parts import drop


def arrive(table: DataFrame, order: str, path: str, slices: int) -> Iterator[int]:
    """Append the rows of ``table`` to the files in ``path`` in ``slices`` runs of a BIGINT order."""
    low, high = table.agg(F.min(order), F.max(order)).first()
    if low is None:
        low, high = 0, 0
    width = (high - low) // slices + 1
    for i in range(slices):
        start = low + i * width
        rows = table.filter((F.col(order) >= start) & (F.col(order) < start + width))
        rows.write.mode("append").parquet(path)
        yield i


def replay(
    table: DataFrame,
    order: str,
    start: Callable[[DataFrame], DataStreamWriter],
    slices: int = 4,
    folder: str | None = None,
) -> None:
    """Let ``table`` arrive in slices, and run the query that ``start`` builds until it has caught up
    after each. Every run but the first resumes from the checkpoint of the one before. The files of a slice go when
    it has been read.
    """
    spark = table.sparkSession
    folder = folder or work_folder(spark, "replay")
    for _ in arrive(table, order, f"{folder}/in", slices):
        source = spark.readStream.schema(table.schema).parquet(f"{folder}/in")
        catch_up(start(source), f"{folder}/checkpoint")
        drop(spark, f"{folder}/in")


def run_until(writer: DataStreamWriter, checkpoint: str, done: Callable[[StreamingQuery], bool], within: float = 1800) -> None:
    """Run a stream until ``done`` holds; an error in it is raised here.

    For streams with timers of processing time: these always have another micro-batch to run, and so never catch up.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(processingTime="500 milliseconds").start()
    deadline = time.monotonic() + within
    try:
        while not done(query):
            if query.awaitTermination(1):
                raise RuntimeError("the stream has stopped")
            if time.monotonic() > deadline:
                raise TimeoutError(f"not done within {within} seconds")
    finally:
        query.stop()


def read_all(query: StreamingQuery) -> bool:
    """Whether a query has read rows since its start, and then found no more."""
    seen = [p.numInputRows for p in query.recentProgress]
    return any(seen) and not seen[-1]


def catch_up(writer: DataStreamWriter, checkpoint: str) -> None:
    """Run a stream over all input there is, then stop."""
    with few_batches(SparkSession.active()):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def few_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside run a few large micro-batches, then stop: they keep whole states of the state store, not changes.

    The run after them starts from the files of the last state. From changes it would put all rows of all runs before
    into an empty store again, so that each run costs more than the last. The rows of the state are not counted, which
    asks the store once more for each row put; these runs report none (``state_rows``).

    The disk holds little that is done with: a micro-batch's shuffles go when it ends, not when the driver happens to
    collect its garbage, and the stores of a run that has ended are closed within seconds (the first stream that a
    process runs decides how many). States are compressed more.
    """
    return configured(spark, {CHANGES: "false", COUNTED: "false", COMPRESSED: "zstd", MAINTAINED: "15s", FREED: "true"})
