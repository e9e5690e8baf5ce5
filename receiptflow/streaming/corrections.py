"""Reports that stay right when a receipt is replaced, or marked as fraud after it was counted.

Per receipt a stored table knows its newest copy and whether it is marked. A micro-batch of transactions and marks looks up
the receipts that it brings, and sends on signed changes: -1 with the row that was counted before, +1 with the one
that counts now. A receipt that is marked counts no more, whichever of the two came first. Sums over the signed changes are
the sums over the newest copies of the receipts without a mark.

The table is in hash buckets of the receipt (``streaming.parts``); a batch reads and writes those it touches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.streaming.parts import State

BUCKETS = 64


def interleaved(tx: DataFrame, marks: DataFrame) -> DataFrame:
    """One log of transactions (with an ``arrival``, which tells the newest copy of a receipt) and fraud marks."""
    kept = F.struct("arrival", "customer_id", F.col("total_amount").cast("double").alias("total_amount"), "receipt_date")
    log = tx.select("receipt_id", kept.alias("tx"), F.lit(False).alias("marked"))
    return log.unionByName(marks.select("receipt_id", F.lit(True).alias("marked")), allowMissingColumns=True)


def changes(log: DataFrame, before: DataFrame) -> DataFrame:
    """(receipt_id, tx, marked, was): the state of each receipt, and the row of it that counted before.

    ``before`` has the receipts' states, (receipt_id, tx, marked), each receipt once. Both sides combine before the exchange, so
    no receipt is hot.
    """
    both = log.withColumn("was", F.lit(None).cast(log.schema["tx"].dataType)).unionByName(before.withColumn("was", F.when(~F.col("marked"), F.col("tx"))))
    return both.groupBy("receipt_id").agg(F.max("tx").alias("tx"), F.bool_or("marked").alias("marked"), F.max("was").alias("was"))


def signed(states: DataFrame) -> DataFrame:
    """(customer_id, total_amount, receipt_date, sign) of what has changed."""
    now, was = F.when(~F.col("marked"), F.col("tx")), F.col("was")
    rows = states.where(~now.eqNullSafe(was))
    rows = rows.select(F.explode(F.array(F.struct(was.alias("tx"), F.lit(-1).alias("sign")), F.struct(now.alias("tx"), F.lit(1).alias("sign")))).alias("x"))
    return rows.where("x.tx IS NOT NULL").select("x.tx.customer_id", "x.tx.total_amount", "x.tx.receipt_date", "x.sign")


def counted(report: DataFrame) -> DataFrame:
    """A report over signed changes without the rows of which nothing is left."""
    return report.where("n <> 0")


def correct(emit: Callable[[DataFrame, int], None], path: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for ``interleaved`` rows: hands signed changes to ``emit(rows, batch_id)``.

    ``emit`` must be safe to repeat for a batch. The states are kept under ``path``, whose ``buckets`` must not change.
    Rows without a receipt id are left out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.where("receipt_id IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
        state = State(batch, batch_id, path, "receipt_id", buckets)
        states = changes(batch, state.before()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            emit(signed(states), batch_id)
            state.write(states.drop("was"))
        finally:
            states.unpersist()
            batch.unpersist()

    return write
