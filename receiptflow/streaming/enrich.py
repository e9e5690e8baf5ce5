"""The two ordered enrichment rules as stateful stream operators.

See ``operators.enrich`` for the rules. Within a micro-batch the rows of a customer are taken in
order of arrival; between micro-batches, in the order of the batches.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from receiptflow.operators.enrich import CUST, TX, enriched, interleave

PAIR = T.StructType([T.StructField("tx", T.StringType()), T.StructField("cust", T.StringType())])
# The processors travel to the workers whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOT = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("body", T.StringType())])
GROUP = "customer_id string, salt int"
#: Groups that the customers are dealt over; fixed for the life of a checkpoint.
BUCKETS = 1024


def enrich_stream(
    tx: DataFrame,
    customers: DataFrame,
    mode: str = "asof",
    salts: int = 8,
    hot_keys: list[str] | None = None,
    ttl: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Enrich a stream of transactions with a stream of customer records (append output).

    With ``asof`` transactions do not affect each other, so those of one customer are spread over
    ``salts`` state groups and the customer's records are copied to each of them. If ``hot_keys`` is
    given (``list(profile(past_transactions, "customer_id").chunks)`` finds them in stored data), only
    those customers are spread, which saves the copies for all others. Both are fixed for the life of
    a checkpoint.
    ``pair_buffer`` depends on every row before it and keeps one group per customer; for customers
    too hot for one task use ``streaming.batches``, which cuts them into chunks.

    State groups share ``buckets`` calls of Python by their hash: a call sorts and pairs the rows of all its customers
    at once, and asks the state store for those that occur. ``buckets`` is fixed for the life of a checkpoint, too.

    State never expires unless ``ttl`` (like "30 days") is given. With it Spark keeps running empty
    micro-batches to expire state, so such a query does not end by itself under ``availableNow``.
    """
    processors = {"asof": AsOf, "pair_buffer": PairBuffer}
    if mode not in processors:
        raise ValueError(f"unknown mode {mode!r}")
    log = interleave(tx, customers)
    parts = _arrival_parts(log)
    packed = log.select(
        "customer_id",
        "kind",
        *[part.alias(name) for name, part in parts.items()],
        F.coalesce(_pack("tx", log), _pack("cust", log)).alias("body"),
        _salts(mode, salts, hot_keys, list(parts.values())).alias("salt"),
    )
    ttl_ms = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)
    bucket = F.pmod(F.xxhash64("customer_id", "salt"), F.lit(buckets)).cast("int")
    pairs = packed.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processors[mode](list(parts), ttl_ms),
        outputStructType=PAIR,
        outputMode="Append",
        timeMode="None" if ttl is None else "ProcessingTime",
    )
    # One generator for each side (of one row) keeps the optimizer from parsing anew for every field.
    read = pairs.select(_read("tx", log), "cust").select("tx", _read("cust", log))
    return read.select(_unpack("tx", log), _unpack("cust", log)).select(*enriched(F.col("tx"), F.col("cust")))


def _arrival_parts(log: DataFrame) -> dict[str, Column]:
    kind = log.schema["arrival"].dataType
    if isinstance(kind, T.StructType):
        return {f"at{i}": F.col("arrival").getField(n).cast("bigint") for i, n in enumerate(kind.names)}
    return {"at0": F.col("arrival").cast("bigint")}


def _salts(mode: str, salts: int, hot_keys: list[str] | None, arrival: list[Column]) -> Column:
    """The state groups of a row: one for a transaction, all of the customer's for its records."""
    if mode != "asof" or salts <= 1:
        return F.lit(0)
    spread = F.lit(salts) if hot_keys is None else F.when(F.col("customer_id").isin(hot_keys), salts).otherwise(1)
    own = F.array(F.pmod(F.xxhash64(*arrival), spread).cast("int"))
    return F.explode(F.when(F.col("kind") == CUST, F.sequence(F.lit(0), spread - 1)).otherwise(own))


def _pack(body: str, log: DataFrame) -> Column:
    """A record as text: Python only sorts and pairs rows, so it moves one string per row."""
    fields = [
        F.unix_micros(f"{body}.{f.name}").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"{body}.{f.name}")
        for f in log.schema[body].dataType.fields
    ]
    return F.when(F.col(body).isNotNull(), F.to_json(F.struct(*fields)))


def _times(body: str, log: DataFrame) -> set[str]:
    return {f.name for f in log.schema[body].dataType.fields if isinstance(f.dataType, T.TimestampType)}


def _read(body: str, log: DataFrame) -> Column:
    times = _times(body, log)
    fields = log.schema[body].dataType.fields
    shape = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in fields])
    return F.explode(F.array(F.from_json(body, shape))).alias(body)


def _unpack(body: str, log: DataFrame) -> Column:
    times = _times(body, log)
    back = [
        (F.timestamp_micros(F.col(body).getField(f.name)) if f.name in times else F.col(body).getField(f.name)).alias(f.name)
        for f in log.schema[body].dataType.fields
    ]
    return F.struct(*back).alias(body)


class _InOrder(StatefulProcessor):
    """Hands a bucket's rows of one micro-batch to ``step``, each customer's in order of arrival."""

    def __init__(self, order: list[str], ttl_ms: int | None = None):
        self.order = order
        self.ttl_ms = ttl_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterable[pd.DataFrame]:
        # One bucket's share of one micro-batch, which the source's per-trigger limit bounds.
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["customer_id", "salt", *self.order, "kind"], kind="stable")
        customer, salt = batch["customer_id"].to_numpy(), batch["salt"].to_numpy()
        heads = np.ones(len(batch), dtype=bool)
        heads[1:] = (customer[1:] != customer[:-1]) | (salt[1:] != salt[:-1])
        groups = list(zip(customer[heads].tolist(), salt[heads].tolist()))
        tx, cust = self.step(groups, heads, batch["kind"].to_numpy() == CUST, batch["body"].to_numpy())
        yield pd.DataFrame({"tx": tx, "cust": cust}, dtype=object)

    def close(self) -> None:
        pass


def _newest(heads: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Per row, the position of the newest chosen row of its group up to it, or -1; ``heads`` start the groups."""
    rows = np.arange(len(heads))
    newest = np.maximum.accumulate(np.where(chosen, rows, -1))
    return np.where(newest < np.maximum.accumulate(np.where(heads, rows, 0)), -1, newest)


class AsOf(_InOrder):
    def init(self, handle: StatefulProcessorHandle) -> None:
        # The customer record, or none and the number of blocks of transactions that wait for one.
        self.customer = handle.getMapState("customer", GROUP, "body string, blocks long", self.ttl_ms)
        self.pending = handle.getMapState("pending", f"{GROUP}, block long", "bodies array<string>", self.ttl_ms)

    def step(self, groups: list[tuple], heads: np.ndarray, is_cust: np.ndarray, body: np.ndarray):
        starts = np.append(np.flatnonzero(heads), len(heads))
        last = _newest(heads, is_cust)
        fresh = np.flatnonzero(is_cust)
        places = np.searchsorted(fresh, starts)
        openings = np.empty(len(groups), dtype=object)
        served = np.ones(len(groups), dtype=bool)
        waiting, opened = [], []
        for g, group in enumerate(groups):
            stored, blocks = self.customer.getValue(group) or (None, 0)
            has_fresh = places[g] < places[g + 1]
            if stored is None and not has_fresh:
                self.pending.updateValue((*group, blocks), (body[starts[g] : starts[g + 1]].tolist(),))
                self.customer.updateValue(group, (None, blocks + 1))
                served[g] = False
                continue
            # Rows with no record before them take the stored one, else the first of this batch.
            openings[g] = body[fresh[places[g]]] if stored is None else stored
            for block in range(blocks):
                held = self.pending.getValue((*group, block))
                if held is not None:  # else it has expired
                    waiting += held[0]
                    opened += [openings[g]] * len(held[0])
                    self.pending.removeKey((*group, block))
            if has_fresh:
                self.customer.updateValue(group, (body[fresh[places[g + 1] - 1]], 0))
        of = np.cumsum(heads) - 1
        leaves = ~is_cust & served[of]
        cust = np.where(last >= 0, body[last], openings[of])[leaves]
        return waiting + list(body[leaves]), opened + list(cust)


class PairBuffer(_InOrder):
    def init(self, handle: StatefulProcessorHandle) -> None:
        # Never both: a transaction waits only while no customer record is stored.
        self.slot = handle.getMapState("slot", GROUP, SLOT, self.ttl_ms)

    def step(self, groups: list[tuple], heads: np.ndarray, is_cust: np.ndarray, body: np.ndarray):
        slots = [self.slot.getValue(group) for group in groups]
        # A state is what one earlier row would have left behind, so it goes in front as that row.
        held = [g for g, slot in enumerate(slots) if slot is not None]
        places = np.flatnonzero(heads)[held]
        heads[places] = False
        heads = np.insert(heads, places, True)
        is_cust = np.insert(is_cust, places, [slots[g][0] == CUST for g in held])
        body = np.insert(body, places, np.array([slots[g][1] for g in held], dtype=object))
        last = _newest(heads, is_cust)
        follows_tx = np.concatenate([[False], ~is_cust[:-1]]) & ~heads
        keeps = _newest(heads, is_cust & ~follows_tx) >= 0
        before = np.concatenate([np.array([None], dtype=object), body[:-1]])
        leaves = is_cust != keeps
        tx = np.where(is_cust, before, body)[leaves]
        cust = np.where(is_cust, body, body[last])[leaves]
        for group, slot, end in zip(groups, slots, np.append(np.flatnonzero(heads)[1:], len(heads)) - 1):
            if keeps[end]:
                left = (CUST, body[last[end]])
            else:
                left = None if is_cust[end] else (TX, body[end])
            if left is None:
                if slot is not None:
                    self.slot.removeKey(group)
            elif slot is None or left != tuple(slot):
                self.slot.updateValue(group, left)
        return list(tx), list(cust)
