"""Spend per customer in windows of processing time, each given out once, when it ends."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from decimal import Decimal, localcontext

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

FIRED = "customer_id string, end_ms long, fired_ms long, total string, n long"
PART = "customer_ids array<string>, totals array<string>, ns array<long>"
#: Groups that the customers are dealt over; fixed for the life of a checkpoint.
BUCKETS = 1024


def spend_fired(tx: DataFrame, size: str = "10 seconds", buckets: int = BUCKETS) -> DataFrame:
    """Total ``total_amount`` of a stream per ``customer_id`` and window, one row for each, in append mode.

    A row belongs to the window in which its micro-batch is processed. A timer set for the window's end gives its
    totals out in the first micro-batch from then on, with or without new rows, and forgets them; so the state holds
    open windows only. Run it with a trigger that goes on, as time alone ends the last windows; a
    query that stops before keeps them in its checkpoint, and fires them when it is started again.

    Customers share timers and state in ``buckets`` groups by their hash, so a micro-batch asks the state store a few
    times per bucket, not per customer.

    Columns: customer_id, window_start, window_end, total, n, fired_at. Sums are exact, as those of ``operators.spend``:
    amounts count as decimals of eight places, null amounts as rows only, and a total without any amount is null.
    """
    millis = int(pd.Timedelta(size).total_seconds() * 1000)
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int").alias("bucket")
    rows = tx.select(bucket, "customer_id", F.col("total_amount").cast("decimal(28,8)").alias("amount"))
    fired = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=WindowTotals(millis), outputStructType=FIRED, outputMode="Append", timeMode="ProcessingTime"
    )
    return fired.select(
        "customer_id",
        F.timestamp_millis(F.col("end_ms") - millis).alias("window_start"),
        F.timestamp_millis("end_ms").alias("window_end"),
        F.col("total").cast("decimal(38,8)").cast("double").alias("total"),
        "n",
        F.timestamp_millis("fired_ms").alias("fired_at"),
    )


class WindowTotals(StatefulProcessor):
    """Keeps the open windows of a bucket's customers by their ends, with a timer for each end.

    A micro-batch leaves its totals of a window as one more part; the parts are added up when the timer fires.
    """

    def __init__(self, millis: int):
        self.millis = millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "end_ms long", "parts long")
        self.parts = handle.getMapState("parts", "end_ms long, part long", PART)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = (timerValues.getCurrentProcessingTimeInMs() // self.millis + 1) * self.millis
        held = self.open.getValue((end,))
        part = 0 if held is None else held[0]
        if held is None:
            self.handle.registerTimer(end)
        totals = Totals()
        for batch in rows:
            amounts = batch["amount"].astype(object).where(batch["amount"].notna(), None)
            totals.add(batch["customer_id"], amounts, itertools.repeat(1))
        self.parts.updateValue((end, part), totals.lists())
        self.open.updateValue((end,), (part + 1,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        held = self.open.getValue((end,))
        if held is not None:
            totals = Totals()
            for part in range(held[0]):
                customers, sums, ns = self.parts.getValue((end, part))
                totals.add(customers, (None if s is None else Decimal(s) for s in sums), ns)
                self.parts.removeKey((end, part))
            self.open.removeKey((end,))
            customers, sums, ns = totals.lists()
            now = timerValues.getCurrentProcessingTimeInMs()
            yield pd.DataFrame({"customer_id": customers, "end_ms": end, "fired_ms": now, "total": sums, "n": ns})

    def close(self) -> None:
        pass


class Totals:
    """Exact sums and row counts by customer."""

    def __init__(self):
        self.sums, self.ns = {}, {}

    def add(self, customers: Iterable, amounts: Iterable, ns: Iterable) -> None:
        with localcontext(prec=60):
            for customer, amount, n in zip(customers, amounts, ns):
                known = self.sums.get(customer)
                self.sums[customer] = known if amount is None else amount if known is None else known + amount
                self.ns[customer] = self.ns.get(customer, 0) + n

    def lists(self) -> tuple[list, list, list]:
        return list(self.sums), [None if s is None else str(s) for s in self.sums.values()], list(self.ns.values())
