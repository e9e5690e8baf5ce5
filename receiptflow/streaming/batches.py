"""The two ordered enrichment rules as a batch job per micro-batch.

Each micro-batch runs the batch form of the rule over its own rows and what earlier batches left
behind, a table with the last state per customer in hash buckets (``streaming.parts``). The work stays in
the JVM and a customer that holds a large share of a batch is cut into chunks like any other batch, so this form
suits large, skewed micro-batches; it reads and writes the buckets whose customers occur, where the state
store of ``streaming.enrich`` touches the customers alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from receiptflow.operators.enrich import CUST, TX, asof_rows, enriched, interleave, pair_buffer_states, pairs
from receiptflow.operators.latest import latest_per_key
from receiptflow.operators.quality import drop_fraud
from receiptflow.operators.skew import Profile, join_unique, profile
from receiptflow.streaming.parts import State

BUCKETS = 64
Emit = Callable[[DataFrame, int], None]


def enrich_batches(
    tx: DataFrame, customers: DataFrame, emit: Emit, state_path: str, mode: str = "asof", buckets: int = BUCKETS
) -> DataStreamWriter:
    """A writer that enriches each micro-batch and hands the rows to ``emit(rows, batch_id)``.

    ``emit`` must be safe to repeat for a batch, as a batch that fails half-way runs again. States are kept under
    ``state_path``; its number of ``buckets`` must not change.
    """
    steps = {"asof": _asof_step, "pair_buffer": _pair_buffer_step}
    step = steps[mode]

    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times; a lost block is read again from the source.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            state = State(batch, batch_id, state_path, "customer_id", buckets)
            step(batch, state.before(), lambda rows: emit(rows, batch_id), state.write)
        finally:
            batch.unpersist()

    return interleave(tx, customers).writeStream.foreachBatch(write)


def without_fraud(marks: Callable[[], DataFrame], emit: Emit) -> Emit:
    """A ``foreachBatch`` function that passes on transactions without a fraud mark.

    ``marks`` reads the marks known by now. The last copy of each receipt in the batch goes on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, "receipt_id", "arrival")
        # One row per receipt is left, so no receipt can be hot.
        emit(drop_fraud(rows, marks(), Profile()), batch_id)

    return write


def _earliest(kind: T.DataType) -> Column:
    """An order value below any other: state counts as having arrived before the batch."""
    lowest = F.lit(-(2**63)).cast("bigint")
    if isinstance(kind, T.StructType):
        return F.struct(*[lowest.alias(n) for n in kind.names])
    return lowest


def _pair_buffer_step(batch: DataFrame, before: DataFrame, emit, leave: Callable[[DataFrame], None]) -> None:
    kind = batch.schema["arrival"].dataType
    hot = profile(batch, "customer_id", "arrival")
    # At most one state row per customer: the stored record, or the transaction that waits.
    log = batch.unionByName(before.withColumn("arrival", _earliest(kind)))
    rows = pair_buffer_states(log, hot)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        emit(pairs(rows))  # the state rows themselves never leave
        final = F.max_by(F.struct("keeps", "stored", "kind", "tx"), F.struct("arrival", "kind")).alias("end")
        keeps, waits = F.col("end.keeps"), ~F.col("end.keeps") & (F.col("end.kind") == TX)
        states = rows.groupBy("customer_id").agg(final).filter(keeps | waits).select(
            "customer_id",
            F.lit(None).cast(kind).alias("arrival"),
            F.when(keeps, CUST).otherwise(TX).alias("kind"),
            F.when(waits, F.col("end.tx")).alias("tx"),
            F.when(keeps, F.col("end.stored")).alias("cust"),
        )
        leave(states)
    finally:
        rows.unpersist()


def _asof_step(batch: DataFrame, before: DataFrame, emit, leave: Callable[[DataFrame], None]) -> None:
    kind = batch.schema["arrival"].dataType
    hot = profile(batch, "customer_id", "arrival")
    known = before.filter(F.col("kind") == CUST)
    waiting = before.filter(F.col("kind") == TX)
    # Transactions that wait have no stored record, so the first record of this batch serves them.
    is_cust = F.col("kind") == CUST
    ends = batch.filter(is_cust).groupBy("customer_id").agg(
        F.min_by("cust", "arrival").alias("opening"), F.max_by("cust", "arrival").alias("latest")
    )
    served = join_unique(waiting, ends.select("customer_id", "opening"), "customer_id", "left")
    fresh = asof_rows(batch.unionByName(known.withColumn("arrival", _earliest(kind))), hot)
    rows = served.select("customer_id", "tx", F.col("opening").alias("cust")).unionByName(
        fresh.select("customer_id", "tx", "cust")
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        emit(rows.filter("cust IS NOT NULL").select(*enriched(F.col("tx"), F.col("cust"))))
        no_order = F.lit(None).cast(kind).alias("arrival")
        still = rows.filter("cust IS NULL").select(
            "customer_id", no_order, F.lit(TX).alias("kind"), "tx", F.lit(None).cast(batch.schema["cust"].dataType).alias("cust")
        )
        newest = known.select("customer_id", F.col("cust").alias("old")).join(
            ends.select("customer_id", "latest"), "customer_id", "full"
        )
        stored = newest.select(
            "customer_id",
            no_order,
            F.lit(CUST).alias("kind"),
            F.lit(None).cast(batch.schema["tx"].dataType).alias("tx"),
            F.coalesce("latest", "old").alias("cust"),
        )
        leave(still.unionByName(stored))
    finally:
        rows.unpersist()
