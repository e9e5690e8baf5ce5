"""Transactions joined with customer details.

Three rules:

``current``      every transaction with the latest record of its customer.
``asof``         every transaction once, with the last customer record that arrived before it, else
                 the first one that arrives after it; held back while there is none.
``pair_buffer``  a two-slot buffer per customer. While no customer record is stored, a transaction
                 waits in its slot (replacing one that waits there) and the next customer record
                 leaves with it, unstored. A customer record that finds no waiting transaction is
                 stored for good, and from then on every transaction leaves with the newest stored
                 record.

The last two follow the order of arrival given by an ``arrival`` column on both sides (BIGINT, or a
struct of BIGINTs); a customer record comes first on ties. Both run as windows per customer. Customers
that hold a large share of the rows are cut into chunks of the order (see ``skew``); each chunk is
one window group and learns what went before it from one summary row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from receiptflow.operators.latest import latest_per_key
from receiptflow.operators.skew import Profile, add_chunk, join_unique, profile
from receiptflow.schemas import CUSTOMER, CUSTOMER_TRANSACTION, TRANSACTION

CUST, TX = 0, 1
ARRIVALS = ["tx_arrival", "customer_arrival"]


def enrich(
    tx: DataFrame, customers: DataFrame, mode: str = "asof", hot: Profile | None = None
) -> DataFrame:
    """Enrich a batch. Columns: the enriched record, then ``tx_arrival`` and ``customer_arrival``
    for the two ordered rules."""
    if mode == "current":
        return enrich_current(tx, customers, hot)
    if mode not in ("asof", "pair_buffer"):
        raise ValueError(f"unknown mode {mode!r}")
    events = interleave(tx, customers)
    if hot is None:
        hot = profile(events, "customer_id", "arrival")
    return (asof if mode == "asof" else pair_buffer)(events, hot)


def enrich_current(tx: DataFrame, customers: DataFrame, hot: Profile | None = None) -> DataFrame:
    """``customers`` may hold several versions per customer if it has an ``arrival`` column."""
    if "arrival" in customers.columns:
        customers = latest_per_key(customers.select(*CUSTOMER.columns, "arrival"), "customer_id", "arrival")
    details = customers.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        F.col("birthdate").alias("customer_birthdate"),
    )
    joined = join_unique(tx.select(*TRANSACTION.columns), details, "customer_id", "inner", hot)
    return joined.select(*CUSTOMER_TRANSACTION.columns)


def interleave(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Both inputs as one log: customer_id, arrival, kind, tx, cust. Batch or stream."""
    tx_body = F.struct(*TRANSACTION.columns, "arrival")
    cust_body = F.struct(*CUSTOMER.columns, "arrival")
    purchases = tx.select("customer_id", "arrival", F.lit(TX).alias("kind"), tx_body.alias("tx"))
    versions = customers.select("customer_id", "arrival", F.lit(CUST).alias("kind"), cust_body.alias("cust"))
    log = purchases.unionByName(versions, allowMissingColumns=True)
    return log.filter("customer_id IS NOT NULL")


def enriched(tx: Column, cust: Column) -> list[Column]:
    """The enriched record; its customer_id is the customer's."""
    own = [c for c in TRANSACTION.columns if c != "customer_id"]
    columns = {c: tx.getField(c) for c in own}
    columns["customer_id"] = cust.getField("customer_id")
    columns["customer_name"] = cust.getField("name")
    columns["customer_email"] = cust.getField("email")
    columns["customer_birthdate"] = cust.getField("birthdate")
    return [columns[c].alias(c) for c in CUSTOMER_TRANSACTION.columns] + [
        tx.getField("arrival").alias("tx_arrival"),
        cust.getField("arrival").alias("customer_arrival"),
    ]


def _chunked(log: DataFrame, hot: Profile):
    log = add_chunk(log, "customer_id", "arrival", hot)
    group = Window.partitionBy("customer_id", "_chunk").orderBy("arrival", "kind")
    return log, group


def _hot_rows(log: DataFrame, hot: Profile) -> DataFrame:
    return log.filter(F.col("customer_id").isin(list(hot.chunks)))


def _chunk_windows():
    """Windows over chunk summaries: at most one row per chunk, and the chunks are bounded."""
    chunks = Window.partitionBy("customer_id").orderBy("_chunk")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    every = chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return chunks, earlier, every


def asof(log: DataFrame, hot: Profile) -> DataFrame:
    rows = asof_rows(log, hot).filter("cust IS NOT NULL")
    return rows.select(*enriched(F.col("tx"), F.col("cust")))


def asof_rows(log: DataFrame, hot: Profile) -> DataFrame:
    """Each transaction with its customer record, null where the customer has none."""
    log, group = _chunked(log, hot)
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = log.select(
        "customer_id",
        "_chunk",
        "kind",
        "tx",
        F.last("cust", True).over(so_far).alias("before"),
        F.first("cust", True).over(whole).alias("first"),
    ).filter(F.col("kind") == TX)
    choice = [F.col("before"), F.col("first")]
    if not hot.empty:
        _, earlier, every = _chunk_windows()
        # Only the customer records are read for this, by far the smaller input.
        found = (
            _hot_rows(log.filter(F.col("kind") == CUST), hot)
            .groupBy("customer_id", "_chunk")
            .agg(F.max_by("cust", "arrival").alias("last"), F.min_by("cust", "arrival").alias("first"))
        )
        ends = (
            hot.chunk_list(log.sparkSession, "customer_id")
            .join(found, ["customer_id", "_chunk"], "left")
            .select(
                "customer_id",
                "_chunk",
                F.last("last", True).over(earlier).alias("earlier"),
                F.first("first", True).over(every).alias("opening"),
            )
        )
        rows = rows.join(F.broadcast(ends), ["customer_id", "_chunk"], "left")
        choice = [F.col("before"), F.col("earlier"), F.col("opening"), F.col("first")]
    return rows.select("customer_id", "tx", F.coalesce(*choice).alias("cust"))


def pair_buffer_states(log: DataFrame, hot: Profile) -> DataFrame:
    """The log with, per row, what the buffer rule needs to know.

    ``prev_kind``/``prev_tx`` describe the row before, ``stored`` is the newest customer record up to
    this row, and ``keeps`` tells whether the buffer has stored a customer record by now. The first
    record to be stored is the first one whose row before is missing or is a customer record too:
    until then records and transactions leave in pairs.
    """
    log, group = _chunked(log, hot)
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = log.select(
        "*",
        F.lag("kind").over(group).alias("prev_kind"),
        F.lag("tx").over(group).alias("prev_tx"),
        F.last("cust", True).over(so_far).alias("stored"),
    )
    unpaired = (F.col("kind") == CUST) & (F.col("prev_kind").isNull() | (F.col("prev_kind") == CUST))
    if not hot.empty:
        place = F.struct("arrival", "kind")
        chunks, earlier, every = _chunk_windows()
        ends = (
            _hot_rows(rows, hot)
            .groupBy("customer_id", "_chunk")
            .agg(
                F.min(place).alias("head"),
                F.max_by(F.struct("kind", "tx"), place).alias("tail"),
                F.max_by("cust", F.when(F.col("kind") == CUST, F.col("arrival"))).alias("last"),
                # The head of a chunk has its row before in another chunk: it is judged below.
                F.min(F.when(unpaired & F.col("prev_kind").isNotNull(), F.col("arrival"))).alias("inner"),
            )
            .select(
                "*",
                F.lag("tail").over(chunks).alias("before"),
                F.last("last", True).over(earlier).alias("earlier"),
            )
            .select(
                "customer_id",
                "_chunk",
                F.lit(True).alias("is_hot"),
                "before",
                "earlier",
                F.min(
                    F.when(
                        (F.col("head.kind") == CUST)
                        & (F.col("before").isNull() | (F.col("before.kind") == CUST)),
                        F.col("head.arrival"),
                    ).otherwise(F.col("inner"))
                ).over(every).alias("from"),
            )
        )
        head = F.col("prev_kind").isNull()
        rows = rows.join(F.broadcast(ends), ["customer_id", "_chunk"], "left").select(
            *log.columns,
            F.coalesce("prev_kind", "before.kind").alias("prev_kind"),
            F.when(head, F.col("before.tx")).otherwise(F.col("prev_tx")).alias("prev_tx"),
            F.coalesce("stored", "earlier").alias("stored"),
            "is_hot",
            "from",
        )
    keeps = F.max(unpaired).over(so_far)
    if not hot.empty:
        keeps = F.when(F.col("is_hot"), F.coalesce(F.col("arrival") >= F.col("from"), F.lit(False))).otherwise(keeps)
    return rows.withColumn("keeps", keeps)


def pair_buffer(log: DataFrame, hot: Profile) -> DataFrame:
    return pairs(pair_buffer_states(log, hot))


def pairs(rows: DataFrame) -> DataFrame:
    """The pairs that leave the buffer, from the rows of ``pair_buffer_states``."""
    is_tx = F.col("kind") == TX
    leaves = (is_tx & F.col("keeps")) | (~is_tx & ~F.col("keeps"))
    return (
        rows.filter(leaves)
        .select(
            F.when(is_tx, F.col("tx")).otherwise(F.col("prev_tx")).alias("tx"),
            F.when(is_tx, F.col("stored")).otherwise(F.col("cust")).alias("cust"),
        )
        .select(*enriched(F.col("tx"), F.col("cust")))
    )
