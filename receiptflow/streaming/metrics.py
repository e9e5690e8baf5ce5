"""Figures about running streams and finished batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("late_rows_dropped", T.LongType()),
    ]
)


def progress_row(progress) -> tuple:
    """One micro-batch's figures, in the order of ``PROGRESS``."""
    operators = progress.stateOperators
    return (
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        progress.durationMs.get("triggerExecution"),
        progress.eventTime.get("watermark"),
        sum(o.numRowsTotal for o in operators),
        sum(o.numRowsDroppedByWatermark for o in operators),
    )


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The latest micro-batches of a query; Spark keeps a fixed number of them."""
    return spark.createDataFrame([progress_row(p) for p in query.recentProgress], PROGRESS)


class ProgressListener(StreamingQueryListener):
    """Hands the figures of every micro-batch of every query to ``report``."""

    def __init__(self, report: Callable[[tuple], None]):
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.report(progress_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, Observation]:
    """Count the rows that pass through ``df`` while it runs, at no extra pass over the data.

    ``figures`` are further aggregates. Read them from the observation after an action.
    """
    observation = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in figures.items()]
    return df.observe(observation, *columns), observation
