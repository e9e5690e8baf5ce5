"""Spend per customer in tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.functions.money import money_sum

#: The columns of ``spend``.
TOTALS = "customer_id string, window_start timestamp, window_end timestamp, total double, n bigint"


def spend(
    tx: DataFrame,
    time: str = "event",
    size: str = "10 seconds",
    delay: str | None = None,
    exact: bool = True,
) -> DataFrame:
    """Total ``total_amount`` per ``customer_id`` and window, on a batch or a stream.

    ``time="event"`` cuts windows by ``receipt_date`` and gives the same answer on every replay;
    ``time="processing"`` cuts them by the moment a row is processed, so no row is ever late. A stream
    by event time keeps all its windows open and loses nothing, unless a ``delay`` is given: then rows
    later than that behind the newest receipt are dropped and counted (``streaming.metrics``), and
    closed windows are forgotten. Rows without ``receipt_date`` belong to no event-time window;
    decode with ``required`` to set them aside.

    Columns: customer_id, window_start, window_end, total, n.
    """
    if time == "event":
        at = F.col("receipt_date")
    elif time == "processing":
        at = F.current_timestamp()
    else:
        raise ValueError(f"time must be 'event' or 'processing', not {time!r}")
    # Project before the exchange: two payload columns travel, whatever the record carries.
    rows = tx.select("customer_id", "total_amount", at.alias("_at")).filter("_at IS NOT NULL")
    if rows.isStreaming and (delay is not None or time == "processing"):
        rows = rows.withWatermark("_at", delay or "0 seconds")
    return (
        rows.groupBy(F.window("_at", size).alias("_window"), "customer_id")
        .agg(money_sum("total_amount", exact).alias("total"), F.count("*").alias("n"))
        .select(
            "customer_id",
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            "total",
            "n",
        )
    )
