"""The prefix trie of conversations, and totals over its subtrees by time-forward processing.

Each node is a sequence of turns that conversations start with, and is named by its least member and its depth. Turns
are put in order over range partitions. A prefix is known by a polynomial hash of its turns modulo 2**127 - 1, which
can be worked out from the middle: each partition hashes its own runs of turns, and the run that a partition border
cuts gets what went before from one value for each partition. So a conversation may have any number of turns.

Totals go up the tree as messages in time. Nodes are dealt into shards (``BLOCK`` conversation ids by ``LAYER`` levels),
and sorted by Spark, shard by shard, in reverse level order. A task reads its nodes once: a node takes the
messages that were sent to it from a priority queue, which spills sorted runs to disk beyond a bound, adds its own
values and sends the sum to its parent. What leaves a shard from its roots is added up for each receiver and carried on in
the same way in the shards it goes to, round after round, until nothing leaves a shard. A node's parent has
a smaller least member or the same, so rounds are at most the shards on a path from a leaf to the root.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import keep
from receiptflow.llm.text import arrow, schema_of
from receiptflow.session import work_folder

#: The prefix hash: h(turns + t) = h(turns) * FACTOR + t + 1, modulo PRIME. FACTOR is an arbitrary number below PRIME.
PRIME, FACTOR = (1 << 127) - 1, 0x5BD1E995A3C59AC2F7C1B3D5E9F00D2B
ROOT = bytes(16)
BLOCK, LAYER, QUEUE, CHUNK = 200, 4096, 100_000, 1 << 20
#: Turns of another conversation that a conversation may start with, at most.
HEAD = 3
WORDS = r"[^\x20\x09-\x0D]+"


def number(value: bytes) -> int:
    return int.from_bytes(value, "big")


def binary(value: int) -> bytes:
    return value.to_bytes(16, "big")


def in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, words), range-partitioned and sorted: the turns of each conversation by ``turn``, null first.

    Equal turns are in order of the first 64 characters of the role, of the text, and last of the hash of both. Only
    these travel, not the text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(role, 1, 64).alias("r"), F.substring(text, 1, 64).alias("t"),
        F.unhex(F.md5(both)).alias("key"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        # Repeated rows can be dealt to several partitions too.
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "r", "t", "key", "copy"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "key", "words")


RUN = schema_of("conv_id long, part int, place long, hash binary, before binary, words long")


def hashed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the turns of each conversation as far as this partition holds them."""
    part, conv, value, place = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        ids, hashes, befores, places = batch.column("conv_id").to_pylist(), [], [], []
        for c, key in zip(ids, batch.column("key").to_pylist(), strict=True):
            if c != conv:
                conv, value, place = c, 0, 0
            befores.append(binary(value))
            value, place = (value * FACTOR + number(key) + 1) % PRIME, place + 1
            hashes.append(binary(value))
            places.append(place)
        yield arrow({"conv_id": ids, "part": [part] * len(ids), "place": places, "hash": hashes, "before": befores, "words": batch.column("words")}, RUN)


def carried(runs: DataFrame) -> dict[int, tuple[int, int, int]]:
    """For each partition that begins within a conversation: its id, its turns in earlier partitions, and their hash.

    One row for each partition reaches the driver.
    """
    ends = runs.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.max(F.struct("conv_id", "place", "hash")).alias("end")
    )
    out, last, turns, value = {}, None, 0, 0
    for row in sorted(ends.collect()):
        if row["first"] == last:
            out[row["part"]] = (last, turns, value)
        place, value_here = row["end"]["place"], number(row["end"]["hash"])
        if row["first"] == row["last"] == last:
            turns, value = turns + place, (value * pow(FACTOR, place, PRIME) + value_here) % PRIME
        else:
            turns, value = place, value_here
        last = row["last"]
    return out


def from_the_start(carry: dict[int, tuple[int, int, int]]):
    """Makes places and hashes of cut conversations count from their first turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for i, (part, conv) in enumerate(zip(rows["part"], rows["conv_id"], strict=True)):
                if part in carry and carry[part][0] == conv:
                    _, turns, value = carry[part]
                    power = pow(FACTOR, rows["place"][i] - 1, PRIME)
                    rows["before"][i] = binary((value * power + number(rows["before"][i])) % PRIME)
                    rows["hash"][i] = binary((value * power * FACTOR + number(rows["hash"][i])) % PRIME)
                    rows["place"][i] += turns
            yield arrow(rows, RUN)

    return run


MEMBER = schema_of("hash binary, parent binary, depth long, conv_id long, words long, ends boolean")


def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of prefixes in which the first ``skip`` turns of a conversation gave way to ``taken`` others."""
    for batch in batches:
        r = batch.to_pydict()
        hashes, parents, depths = [], [], []
        for place, skip, taken, new, old, now, before in zip(r["place"], r["skip"], r["taken"], r["new"], r["old"], r["hash"], r["before"], strict=True):
            change = (number(new) - number(old)) * pow(FACTOR, place - 1 - skip, PRIME)
            hashes.append(binary((change * FACTOR + number(now)) % PRIME))
            parents.append(binary((change + number(before)) % PRIME))
            depths.append(taken + place - skip)
        ends = [d == n for d, n in zip(depths, r["length"], strict=True)]
        yield arrow({"hash": hashes, "parent": parents, "depth": depths, "conv_id": r["conv_id"], "words": r["words"], "ends": ends}, MEMBER)


def members(conversations: DataFrame, base: Column | None = None, head: Column | None = None) -> DataFrame:
    """(hash, parent, depth, conv_id, words, ends): a row for each conversation and node on its path, the root included.

    With ``base`` and ``head`` (expressions over ``conv_id``; ``head`` at most ``HEAD``) the first ``head`` turns of a
    conversation give way to those of the conversation ``base``, as many as there are. ``ends`` marks its last node.
    """
    spark = conversations.sparkSession
    runs = keep(in_order(conversations).mapInArrow(hashed_runs, RUN), f"{work_folder(spark, 'trie')}/runs")
    turns = runs.mapInArrow(from_the_start(carried(runs)), RUN)
    first = [F.max(F.when(F.col("place") == i, F.struct("hash", "words"))).alias(f"t{i}") for i in range(1, HEAD + 1)]
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"), *first)
    heads = convs.select("conv_id", "n", F.array(*[f"t{i}" for i in range(1, HEAD + 1)]).alias("t"))
    base, head = base if base is not None else F.col("conv_id"), head if head is not None else F.lit(0)
    own = heads.withColumns({"base": base, "skip": head.cast("int")})
    other = heads.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("t").alias("base_t"))
    taken = F.least("skip", F.coalesce("base_n", F.lit(0))).cast("int")
    nothing = F.lit(ROOT)
    up_to = lambda t, n: F.coalesce(F.get(F.col(t), F.col(n) - 1)["hash"], nothing)
    plan = own.join(other, "base", "left").withColumn("taken", taken)
    plan = plan.select(
        "conv_id", "n", "skip", "taken", F.slice(F.coalesce("base_t", F.array().cast(heads.schema["t"].dataType)), 1, F.col("taken")).alias("heads"),
        (F.col("taken") + F.greatest(F.col("n") - F.col("skip"), F.lit(0))).alias("length"),
        up_to("base_t", "taken").alias("new"), up_to("t", "skip").alias("old"),
    )
    root = plan.select(nothing.alias("hash"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", F.lit(0).cast("long").alias("words"), (F.col("length") == 0).alias("ends"))
    top = plan.select("conv_id", "length", "heads", F.posexplode("heads").alias("i", "turn"))
    before = F.when(F.col("i") == 0, nothing).otherwise(F.get("heads", F.col("i") - 1)["hash"])
    top = top.select("turn.hash", before.alias("parent"), (F.col("i") + 1).cast("long").alias("depth"), "conv_id", "turn.words", (F.col("i") + 1 == F.col("length")).alias("ends"))
    rest = turns.join(plan.where("n > skip").drop("n", "heads"), "conv_id").where("place > skip").mapInArrow(tails, MEMBER)
    return root.unionByName(top).unionByName(rest)


def ends_digest(rows: DataFrame) -> DataFrame:
    """(hash, sha): the SHA-256 of each node's ``conv_id`` in ascending order, as decimals with commas between.

    Ids are sorted over range partitions and written down as pieces of at most ``CHUNK`` bytes; the pieces of a node then
    pass one task in a row, as a SHA-256 can only be worked out from its start, with one piece in memory.
    """
    piece, result = schema_of("hash binary, first long, ids string"), schema_of("hash binary, sha string")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, size = None, 0, [], 0
        for batch in batches:
            out = {"hash": [], "first": [], "ids": []}
            for node, conv in zip(batch.column("hash").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (node != now or size > CHUNK):
                    for name, value in (("hash", now), ("first", first), ("ids", ",".join(ids))):
                        out[name].append(value)
                    ids, size = [], 0
                if not ids:
                    now, first = node, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield arrow(out, piece)
        if ids:
            yield arrow({"hash": [now], "first": [first], "ids": [",".join(ids)]}, piece)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = {"hash": [], "sha": []}
            for node, ids in zip(batch.column("hash").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if node != now:
                    if state:
                        out["hash"].append(now)
                        out["sha"].append(state.hexdigest())
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield arrow(out, result)
        if state:
            yield arrow({"hash": [now], "sha": [state.hexdigest()]}, result)

    sorted_ids = rows.select("hash", "conv_id").repartitionByRange("hash", "conv_id").sortWithinPartitions("hash", "conv_id")
    written = sorted_ids.mapInArrow(pieces, piece)
    return written.repartition("hash").sortWithinPartitions("hash", "first").mapInArrow(digests, result)


class Messages:
    """Values sent to nodes, taken out in the order in which the nodes come; beyond ``limit`` the later half goes to disk."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def send(self, to: tuple, values: tuple[int, int]) -> None:
        heapq.heappush(self.heap, (to, values))
        if len(self.heap) > self.limit:
            self.spill()

    def spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        file = tempfile.TemporaryFile()
        for i in range(half, len(self.heap), 1000):
            pickle.dump(self.heap[i : i + 1000], file)
        del self.heap[half:]
        file.seek(0)
        self.spills += 1
        self.advance(self.read(file), self.spills)

    @staticmethod
    def read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def advance(self, run: Iterator[tuple], tag: int) -> None:
        """Put a run back with its next message, if it has one."""
        message = next(run, None)
        if message is not None:
            heapq.heappush(self.runs, (message, tag, run))

    def take(self, node: tuple) -> tuple[int, int]:
        """The sums of all that was sent to ``node``."""
        leaves = saved = 0
        while self.heap and self.heap[0][0] == node:
            _, (a, b) = heapq.heappop(self.heap)
            leaves, saved = leaves + a, saved + b
        while self.runs and self.runs[0][0][0] == node:
            (_, (a, b)), tag, run = heapq.heappop(self.runs)
            leaves, saved = leaves + a, saved + b
            self.advance(run, tag)
        return leaves, saved


PASSED = schema_of("conv_id long, depth long, parent_conv_id long, leaves long, saved long, leaves_shard boolean")


def forwarded(queue: int = QUEUE):
    """Sends totals up within each shard, reading its nodes in reverse level order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        messages = Messages(queue)
        for batch in batches:
            r = batch.to_pydict()
            out = {name: [] for name in PASSED.names}
            for shard, depth, conv, parent, inside, leaves, saved in zip(r["shard"], r["depth"], r["conv_id"], r["parent_conv_id"], r["inside"], r["leaves"], r["saved"], strict=True):
                a, b = messages.take((shard, -depth, conv))
                leaves, saved = leaves + a, saved + b
                if not leaves and not saved:
                    continue
                if inside:
                    messages.send((shard, 1 - depth, parent), (leaves, saved))
                for name, value in zip(PASSED.names, (conv, depth, parent, leaves, saved, parent is not None and not inside), strict=True):
                    out[name].append(value)
            yield arrow(out, PASSED)

    return run


def subtree_totals(tree: DataFrame, block: int = BLOCK, layer: int = LAYER, queue: int = QUEUE) -> DataFrame:
    """(conv_id, depth, leaves, saved): the sums of ``leaves`` and ``saved`` over each node's subtree, itself included.

    ``tree`` has a row for each node: conv_id and depth name it, parent_conv_id and depth - 1 its parent (null: a root).
    Nodes without any total have no row.
    """
    folder = work_folder(tree.sparkSession, "forward")
    shard = lambda conv, depth: F.concat_ws(":", F.floor(F.col(conv) / block), F.floor(depth / layer))
    here = shard("conv_id", F.col("depth"))
    inside = F.coalesce(here == shard("parent_conv_id", F.col("depth") - 1), F.lit(False)) & F.col("parent_conv_id").isNotNull()
    nodes = tree.select("conv_id", "depth", "parent_conv_id", here.alias("shard"), inside.alias("inside"), "leaves", "saved")
    bare, rounds = nodes.drop("leaves", "saved"), []
    while True:
        dealt = nodes.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "conv_id")
        rounds.append(keep(dealt.mapInArrow(forwarded(queue), PASSED), f"{folder}/{len(rounds)}"))
        leaving = rounds[-1].where("leaves_shard").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        leaving = leaving.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        if leaving.isEmpty():
            break
        reached = leaving.select(here.alias("shard")).distinct()
        nodes = bare.join(reached, "shard", "left_semi").join(leaving, ["conv_id", "depth"], "left").fillna(0, ["leaves", "saved"])
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def prefix_trie(conversations: DataFrame, base: Column | None = None, head: Column | None = None) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role and text; a null role or text is empty, rows without a conv_id are left
    out, other columns take no part. Repeated rows are repeated turns. An empty table has no nodes, not even a root. See
    ``members`` for ``base`` and ``head``, and ``in_order`` for equal turns. ``saved_tokens`` adds up, over the subtree, the
    words of a node's last text for every member but one: what is saved by a cache of prefixes.
    """
    folder = work_folder(conversations.sparkSession, "trie")
    paths = keep(members(conversations, base, head), f"{folder}/members")
    nodes = paths.groupBy("hash").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"),
    )
    nodes = keep(nodes, f"{folder}/nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("hash")).agg(F.count("*").alias("n_children"))
    owners = nodes.select(F.col("hash").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tree = nodes.join(children, "hash", "left").join(owners, "parent", "left").fillna(0, ["n_children"])
    tree = tree.select(
        "hash", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    tree = keep(tree, f"{folder}/tree")
    totals = subtree_totals(tree).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    digests = ends_digest(paths.where("ends"))
    rows = tree.drop("leaves", "saved").join(totals, ["conv_id", "depth"], "left").join(digests, "hash", "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
