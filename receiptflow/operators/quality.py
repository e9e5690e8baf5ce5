"""Cleaning: duplicate receipts and receipts marked as fraud."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from receiptflow.operators.latest import latest_per_key
from receiptflow.operators.skew import Profile, join_unique


def dedupe(tx: DataFrame, order: Column | str | None = None, delay: str | None = None) -> DataFrame:
    """One row per ``receipt_id``: the last one in a batch, the first one seen in a stream.

    A stream remembers every receipt. With a ``delay`` it forgets those that the watermark on
    ``receipt_date`` has passed by as much, which bounds its state, but then receipts that are older than
    the watermark when they come are lost, and copies without a date pass each time.
    """
    if tx.isStreaming and delay is None:
        return tx.dropDuplicates(["receipt_id"])
    if tx.isStreaming:
        return tx.withWatermark("receipt_date", delay).dropDuplicatesWithinWatermark(["receipt_id"])
    if order is None:
        raise ValueError("a batch needs an order to tell which copy of a receipt is the last")
    return latest_per_key(tx, "receipt_id", order)


def drop_fraud(tx: DataFrame, fraud: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Transactions whose receipt carries no fraud mark. ``fraud`` is a batch; marks may repeat.

    On a stream of transactions call this inside ``foreachBatch`` with the current fraud table.
    """
    marks = fraud.select("receipt_id").filter("receipt_id IS NOT NULL").distinct()
    return join_unique(tx, marks, "receipt_id", "left_anti", profile)
