"""Spend in windows of event time that sets late rows aside instead of losing them.

Each micro-batch compares its rows with the watermark: the newest receipt of all batches before, less the delay.
Rows of windows that the watermark has passed go whole to a side table, as do rows without a date; all others
are folded into the windows. A window that the watermark has passed is therefore final, and nothing is lost: the side
table can be added back. A batch that runs again finds the same watermark and splits its rows alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.sinks import tables
from receiptflow.streaming.parts import drop, number_in, paths
from receiptflow.streaming.reports import Report, maintain, read_report


def windows(size: str = "10 seconds") -> Report:
    """Sums and counts per customer and window, in parts of a day. With a ``sign`` rows may take back others."""

    def partial(rows: DataFrame) -> DataFrame:
        sign = F.col("sign") if "sign" in rows.columns else F.lit(1)
        amount = F.sum(sign * F.col("total_amount").cast("decimal(28,8)")).cast("decimal(38,8)")
        # Rows without a date are in no window.
        sums = rows.groupBy("customer_id", F.window("receipt_date", size).alias("_window")).agg(amount.alias("total"), F.sum(sign).cast("bigint").alias("n"))
        return sums.select("customer_id", F.col("_window.start").alias("window_start"), "total", "n")

    return Report(
        {"customer_id": "string", "window_start": "timestamp"}, {"total": "decimal(38,8)", "n": "bigint"},
        lambda: F.unix_date(F.to_date("window_start")), partial,
    )


def _newest(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest receipt, in microseconds, that the batches before have seen."""
    done = [p.removesuffix("/_SUCCESS") for p in paths(spark, f"{path}/batch=*/_SUCCESS")]
    earlier = sorted((p for p in done if number_in(p + "/", "batch") < batch_id), key=lambda p: number_in(p + "/", "batch"))
    for folder in earlier[:-1]:
        drop(spark, folder)
    return spark.read.schema("newest bigint").parquet(earlier[-1]).first()[0] if earlier else None


def keep_late(path: str, size: str = "10 seconds", delay: str = "0 seconds") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for transactions: ``path/totals`` holds the windows, ``path/late`` the late rows."""
    fold, aside = maintain(windows(size), f"{path}/totals"), tables.append_batch(f"{path}/late")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = _newest(spark, f"{path}/seen", batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dated = batch.where("receipt_date IS NOT NULL").withColumn("_window", F.window("receipt_date", size))
            passed = F.timestamp_micros(F.lit(newest).cast("bigint")) - F.expr(f"INTERVAL {delay}")
            is_late = F.coalesce(F.col("_window.end") <= passed, F.lit(False))
            late = dated.where(is_late).drop("_window").unionByName(batch.where("receipt_date IS NULL"))
            aside(late, batch_id)
            fold(dated.where(~is_late).drop("_window"), batch_id)
            seen = batch.agg(F.greatest(F.max(F.unix_micros("receipt_date")), F.lit(newest).cast("bigint")).alias("newest"))
            seen.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def read_late(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows that were set aside; ``schema`` is that of the transactions."""
    return tables.read_batches(spark, f"{path}/late", schema).drop("run", "batch")


def read_windows(spark: SparkSession, path: str, size: str = "10 seconds") -> DataFrame:
    """The windows without the late rows. Columns: customer_id, window_start, total, n."""
    return read_report(spark, windows(size), f"{path}/totals")


def added_back(spark: SparkSession, path: str, schema: T.StructType | str, size: str = "10 seconds") -> DataFrame:
    """The windows with the late rows, and how many of them were late: the columns of ``read_windows`` and n_late."""
    late = windows(size).partial(read_late(spark, path, schema)).withColumn("n_late", F.col("n"))
    on_time = read_windows(spark, path, size).withColumns({"total": F.col("total").cast("decimal(38,8)"), "n_late": F.lit(0).cast("bigint")})
    both = on_time.unionByName(late).groupBy("customer_id", "window_start")
    return both.agg(F.sum("total").cast("double").alias("total"), F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))
