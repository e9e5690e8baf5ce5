"""Interleaves sources by target weights with Pfair scheduling.

Time is a row of slots, each for one block of ``block`` documents of one source. Weights are whole numbers
of slots in a period of ``period`` slots. Block j of a source of weight w is released at slot
floor(j period / w) and due by ceil((j + 1) period / w); each slot goes to the released block whose
deadline is earliest. The weights add up to the period, so no block is late, and after any number of
slots each source is less than one block away from its share.

Without a given period the targets hold as they are (``phases``): up to the slot where the first source runs
out, blocks are dealt by largest remainders of the targets, then those of the sources that are left, and so
on. Phases longer than ``SLOTS`` repeat a period of so many. The phases are numbers of blocks by source, which
each task works out for itself; the schedule is a table on Spark, a row for each block, and any number of
sources fits. With a period given, as the SQL of ``op6_source_mix`` has it, one period is worked out and every
block finds its slot by its number; there each source has a slot of its own first, which draws shares together.

Documents are numbered within their source over range partitions, so the largest source is spread
over as many tasks as its size asks for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import batched
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from receiptflow.llm.components import keep
from receiptflow.llm.text import arrow, schema_of
from receiptflow.session import work_folder

BLOCK, PERIOD = 16, 1000
#: Slots of a period that a long phase repeats, at least, and tasks that lay out phases.
SLOTS, TASKS = 1 << 18, 16

LAID = schema_of("source string, block long, weight long, slot long, period long, periods long, in_mix boolean")


def shares(wanted: dict[str | None, int], period: int = PERIOD) -> dict[str | None, int]:
    """Whole slots per period, at least one each, in proportion to ``wanted``; largest remainders first."""
    if len(wanted) > period:
        raise ValueError(f"{len(wanted)} sources need a period of as many slots; it has {period}")
    free, total = period - len(wanted), sum(wanted.values())
    out = {s: 1 + w * free // total for s, w in wanted.items()}
    rank = sorted(wanted, key=lambda s: (-(wanted[s] * free % total), s is not None, s or ""))
    for s in rank[: period - sum(out.values())]:
        out[s] += 1
    return out


def turns(weights: list[int], period: int) -> Iterator[tuple[int, int]]:
    """Which weight each slot of a period goes to, and which of its blocks."""
    waiting = [(0, i, 0) for i in range(len(weights))]
    ready: list[tuple[int, int, int]] = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // weights[i]), i, j))
        _, i, j = heapq.heappop(ready)
        yield i, j
        heapq.heappush(waiting, ((j + 1) * period // weights[i], i, j + 1))


def schedule(weights: dict[str | None, int], period: int = PERIOD) -> list[str | None]:
    """The source of each slot of a period."""
    order = sorted(weights, key=lambda s: (s is not None, s or ""))
    return [order[i] for i, _ in turns([weights[s] for s in order], period)]


class Phase(NamedTuple):
    """Equal periods: the first slot, their length and number, and sources with first blocks and blocks a period."""

    start: int
    period: int
    periods: int
    sources: np.ndarray
    first: np.ndarray
    weights: np.ndarray
    in_mix: bool


def phases(blocks: list[int], wanted: list[int], longest: int = SLOTS) -> Iterator[Phase]:
    """Deals all blocks of all sources by the targets ``wanted`` of those that are left.

    A phase ends where the first of its sources runs out. Blocks are rounded to the targets by largest remainders,
    so within a period each source is less than two blocks away from its target. A phase of more than ``longest``
    slots repeats a period of so many, or of as many as the least target asks for, then ends with a shorter one.
    Sources without a target come in equal parts after all others.
    """
    left, total, start = np.array(blocks, np.int64), sum(blocks), 0
    top = max(1, -(-max(wanted, default=1) * (total + 1) >> 62))
    wanted = np.array([-(-w // top) for w in wanted], np.int64)
    done, alone = np.zeros(len(left), np.int64), np.count_nonzero(left) == 1
    while left.any():
        live = np.flatnonzero((left > 0) & (wanted > 0))
        target = wanted[live]
        in_mix = len(live) > 1 or alone
        if not len(live):
            live = np.flatnonzero(left)
            target = np.ones(len(live), np.int64)
        weight, rest = sum(target.tolist()), left[live]
        end = int(np.argmin(rest / target))
        length = -(-int(rest[end]) * weight // int(target[end]))
        period = min(length, max(longest, -(-weight // int(target.min()))))
        part, over = np.divmod(period * target, weight)
        part = np.minimum(part, rest)
        more = np.lexsort((live, -over))
        more = more[part[more] < rest[more]][: period - int(part.sum())]
        part[more] += 1
        if period == length:
            part[end] = rest[end]
        some = np.flatnonzero(part)
        live, part = live[some], part[some]
        period, periods = int(part.sum()), 1 if period == length else max(1, int((left[live] // part).min()))
        yield Phase(start, period, periods, live, done[live], part, in_mix)
        left[live] -= part * periods
        done[live] += part * periods
        start += period * periods


def lay_out(names: list[str | None], blocks: list[int], wanted: list[int], longest: int, tasks: int):
    """Rows of ``LAID``, one for each block of a period, of the phases that fall to a task."""

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (t for batch in batches for t in batch.column(0).to_pylist()):
            for number, p in enumerate(phases(blocks, wanted, longest)):
                if number % tasks != task:
                    continue
                for run in batched(enumerate(turns(p.weights.tolist(), p.period)), 1 << 16):
                    place, i, j = np.array([(slot, *turn) for slot, turn in run], np.int64).T
                    same = lambda value: [value] * len(place)  # noqa: B023, E731
                    yield arrow({
                        "source": [names[x] for x in p.sources[i]], "block": p.first[i] + j, "weight": p.weights[i], "slot": p.start + place,
                        "period": same(p.period), "periods": same(p.periods), "in_mix": same(p.in_mix),
                    }, LAID)

    return laid


def placed_by_phases(ids: DataFrame, sizes: dict[str | None, int], wanted: dict[str | None, int], block: int, longest: int) -> DataFrame:
    """The result of ``slots`` by the phases of the targets."""
    names = sorted(sizes, key=lambda s: (s is not None, s or ""))
    deal = lay_out(names, [-(-sizes[s] // block) for s in names], [wanted[s] for s in names], longest, TASKS)
    laid = ids.sparkSession.range(0, TASKS, 1, TASKS).mapInArrow(deal, LAID)
    laid = laid.withColumn("again", F.explode(F.sequence(F.lit(0).cast("long"), F.col("periods") - 1)))
    at = lambda x, step: (F.col(x) + F.col("again") * F.col(step)).alias(x)
    laid = laid.select("source", at("block", "weight"), at("slot", "period"), "in_mix").alias("p")
    rows = numbered(ids).withColumn("block", F.floor(F.col("number") / block)).alias("n")
    rows = rows.join(laid, F.col("n.source").eqNullSafe(F.col("p.source")) & (F.col("n.block") == F.col("p.block")))
    return rows.select("n.source", "n.doc_id", "n.block", "p.slot", "p.in_mix")


def numbered(ids: DataFrame) -> DataFrame:
    """(source, doc_id, number): each distinct id's place in its source, in ascending order, from 0.

    Ids are dealt to range partitions, whose sizes per source are added up; within a partition a
    window numbers them. No task holds more than a partition of a source.
    """
    spark, folder = ids.sparkSession, work_folder(ids.sparkSession, "mixing")
    dealt = ids.distinct().repartitionByRange("source", "doc_id").withColumn("part", F.spark_partition_id())
    dealt = keep(dealt, f"{folder}/dealt")
    sizes = dealt.groupBy("source", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")
    sizes = sizes.select("source", "part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("source", "part").orderBy("doc_id")) - 1
    rows = dealt.withColumn("place", place).alias("d").join(sizes.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.part") == F.col("s.part")))
    return rows.select("d.source", "d.doc_id", (F.col("before") + F.col("place")).alias("number"))


def slots(docs: DataFrame, targets: dict[str | None, int] | None = None, block: int = BLOCK, period: int | None = None, longest: int = SLOTS) -> DataFrame:
    """(source, doc_id, block, slot, in_mix) for each distinct source and id of ``docs``.

    ``targets`` are whole numbers for the sources, by default the integer roots of a million times their sizes.
    When a source has run out the others go on by their targets; ``in_mix`` marks the documents up to where
    fewer than two sources with a target are left. Sources that ``targets`` does not name come last.

    With a ``period``, every source gets at least one slot a period, sources not named as well; slots of a source
    that has run out stay empty, and ``in_mix`` marks the documents before the first empty slot. More
    sources than the period has slots are placed as without one. A null source is a source, a null id an id.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("source").alias("source"), "doc_id")
    # One row for each source.
    sizes = {r[0]: r[1] for r in ids.groupBy("source").agg(F.count_distinct(F.struct("doc_id"))).collect()}
    if not sizes:
        return docs.select("source", "doc_id").withColumns({"block": F.lit(0).cast("long"), "slot": F.lit(0).cast("long"), "in_mix": F.lit(True)})
    wanted = {s: (targets or {}).get(s, 0) if targets else isqrt(1_000_000 * n) for s, n in sizes.items()}
    if period is None or len(sizes) > period:
        return placed_by_phases(ids, sizes, wanted, block, longest)
    weights = shares(wanted, period)
    plan, seen, places = schedule(weights, period), {}, []
    for slot, source in enumerate(plan):
        places.append((source, seen.get(source, 0), weights[source], slot))
        seen[source] = seen.get(source, 0) + 1
    at = {(source, k): slot for source, k, _, slot in places}
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    horizon = min(blocks[s] // w * period + at[s, blocks[s] % w] for s, w in weights.items())
    # ``period`` rows.
    table = F.broadcast(spark.createDataFrame(places, "source string, k long, weight long, place long").alias("p"))
    widths = F.broadcast(spark.createDataFrame(list(weights.items()), "source string, weight long").alias("w"))
    rows = numbered(ids).withColumn("block", F.floor(F.col("number") / block)).alias("n")
    rows = rows.join(widths, F.col("n.source").eqNullSafe(F.col("w.source"))).select("n.*", "w.weight").alias("n")
    rows = rows.join(table, F.col("n.source").eqNullSafe(F.col("p.source")) & (F.col("n.block") % F.col("n.weight") == F.col("p.k")))
    slot = F.floor(F.col("n.block") / F.col("n.weight")) * period + F.col("p.place")
    return rows.select("n.source", "n.doc_id", "n.block", slot.alias("slot")).withColumn("in_mix", F.col("slot") < horizon)


def mixed(docs: DataFrame, targets: dict[str | None, int] | None = None, block: int = BLOCK, period: int | None = None) -> DataFrame:
    """``docs`` in the order of the mix, with ``slot`` and ``in_mix``; all rows stay.

    Columns of these two names are replaced. Repeated rows share their place.
    """
    placed = slots(docs, targets, block, period).select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), "slot", "in_mix")
    rows = docs.drop("slot", "in_mix")
    joint = rows.join(placed, rows["source"].eqNullSafe(placed["_s"]) & rows["doc_id"].eqNullSafe(placed["_d"]))
    return joint.drop("_s", "_d").orderBy("slot", "doc_id")
