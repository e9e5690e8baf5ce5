"""Near-duplicate documents by bottom-k sketches.

A document is the set of its distinct five-word shingles, each known by a 63-bit hash; texts of fewer
words are one shingle, texts without words have none. Its sketch is the ``K`` least hashes.

1. Documents with equal sets form a class, known by a 128-bit hash of the set.
2. Inverted lists of retained values generate overlaps. Two sets of Jaccard similarity 0.75 share at
   least ``shared(n)`` retained values, but for a chance under 1e-8 a pair; so they meet in the lists
   of their rarest values, and each class is listed only under those. Passages that very many
   documents hold are the most frequent values and drop out first. Classes that meet others in
   these lists are listed once more by wider sketches, whose bound is tighter.
3. A candidate pair passes if the sketch of its union, made from both sketches, lets 0.75 seem
   possible, and is a link if the whole sets have it exactly.
4. Links are looked for in rounds. A round compares each class with the few classes that come first,
   in a new random order, in most of its lists, and merges what is linked; members of one component
   are never compared again. In the end, classes that share lists with other components form
   families, where those outside the largest component are compared with all others by counting.

So a group of copies costs one comparison each, no pairs within a group are emitted, and every link
that changes a component is found, whatever the rounds before have found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import components, keep
from receiptflow.llm.text import Hashes, arrow, bounded, flat, pieces, schema_of, windows
from receiptflow.session import work_folder

WORDS = 5
K, WIDE = 64, 512
#: Retained values shared at 0.75: three quarters expected, less six standard deviations.
LEAST_SHARED = {K: 27, WIDE: 325}
SKETCHES = schema_of("doc_id long, row long, cls binary, n long, sketch array<long>")
SETS = schema_of("id long, n long, sketch array<long>, shingles binary")
VERIFIED = schema_of("a long, b long")
ACROSS = schema_of("a long, b long, sure boolean")
#: Rounds, classes that a class is compared with in each, and members in a block of a family.
ROUNDS, HUBS, FAMILY = 2, 3, 4000


def shingles(text: bytes, hashes: Hashes) -> np.ndarray:
    """The ascending distinct shingle hashes of a text."""
    words = hashes.of(text.lower().split())
    return np.unique(windows(words, min(WORDS, len(words))) >> np.uint64(1)).astype(np.int64) if len(words) else np.empty(0, np.int64)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for rows, texts in pieces(batches):
        sets = [shingles(text, hashes) for text in texts]
        yield arrow({
            "doc_id": rows.column("doc_id"), "row": rows.column("row"), "n": [len(s) for s in sets], "sketch": [s[:K] for s in sets],
            "cls": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
        }, SKETCHES)


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for rows, texts in pieces(batches):
        sets = [shingles(text, hashes) for text in texts]
        meant = [i for i, cls in enumerate(rows.column("cls").to_pylist()) if xxhash.xxh3_128_digest(sets[i].tobytes()) == cls]
        ids, own = rows.column("id").to_pylist(), [sets[i] for i in meant]
        yield arrow({"id": [ids[i] for i in meant], "n": [len(s) for s in own], "sketch": [s[:WIDE] for s in own], "shingles": [s.tobytes() for s in own]}, SETS)


def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets have a similarity of 0.75 or more."""
    for rows in batches:
        good = []
        for left, right in zip(rows.column("left"), rows.column("right"), strict=True):
            a, b = np.frombuffer(left.as_buffer(), np.int64), np.frombuffer(right.as_buffer(), np.int64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * both >= 75 * (len(a) + len(b) - both))
        yield arrow({"a": rows.column("a").filter(pa.array(good, pa.bool_())), "b": rows.column("b").filter(pa.array(good, pa.bool_()))}, VERIFIED)


def shared(n: Column, k: int) -> Column:
    """The least number of ``k`` retained values that a set of ``n`` shares with a similar one."""
    return F.when(n <= k * 3 // 4, F.ceil(n * 3 / 4)).otherwise(LEAST_SHARED[k])


def close_sizes(a: Column, b: Column) -> Column:
    return (100 * a >= 75 * b) & (100 * b >= 75 * a)


def prefixes(classes: DataFrame, k: int) -> DataFrame:
    """(v, id, n): each class under the rarest of its values that other classes hold as well."""
    values = classes.select("id", "n", F.explode("sketch").alias("v"))
    frequent = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    both = values.join(frequent, "v")
    ranked = both.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("listed"))
    size = F.size("listed") - shared(F.col("n"), k) + 1
    return ranked.where(size > 0).select("id", "n", F.explode(F.slice("listed", F.lit(1), size.cast("int"))).alias("e")).select("e.v", "id", "n")


def verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) that are links."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("sketch").alias(f"s{x}"))
    least = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
    common = F.size(F.array_intersect(least, F.array_intersect("sa", "sb")))
    possible = common >= F.floor(F.size(least) * F.lit(LEAST_SHARED[K] / K))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").where(possible).select("a", "b")
    full = lambda x, name: sets.select(F.col("id").alias(x), F.col("shingles").alias(name))
    return likely.join(full("a", "left"), "a").join(full("b", "right"), "b").mapInArrow(exact, VERIFIED)


def star(listed: DataFrame, round_: int) -> DataFrame:
    """For each class the ``HUBS`` classes that come first, in an order of the round, in most of its lists."""
    hub = listed.groupBy("v").agg(F.min(F.struct(F.xxhash64("id", F.lit(round_)).alias("o"), "id", "n", "comp")).alias("hub"))
    met = listed.join(hub, "v").where((F.col("comp") != F.col("hub.comp")) & close_sizes(F.col("n"), F.col("hub.n")))
    met = met.groupBy("id", F.col("hub.id").alias("b")).agg(F.count("*").alias("lists"))
    most = F.slice(F.sort_array(F.collect_list(F.struct("lists", "b")), asc=False), 1, HUBS)
    return met.groupBy("id").agg(most.alias("hubs")).select(F.col("id").alias("a"), F.explode("hubs.b").alias("b"))


def families(listed: DataFrame) -> DataFrame:
    """(node, component): the classes that share lists with classes of other components, and what ties them."""
    ends = listed.groupBy("v").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("id").alias("b"))
    edges = listed.join(ends.where("low < high").select("v", "b"), "v").select(F.col("id").alias("a"), "b").distinct()
    return components(edges)


def across(group: pa.Table) -> pa.Table:
    """Links between components of a family: each query counts its values in the block's inverted lists.

    Of links that tie components already tied here, only one is returned, and no candidates. Sets too large for
    their wide sketch give candidates.
    """
    n, comp, ids = (group.column(c).to_numpy() for c in ("n", "comp", "id"))
    lists = group.column("sketch").combine_chunks()
    ends, every = lists.offsets.to_numpy(), lists.values.to_numpy()
    sketch_of = lambda i: every[ends[i] : ends[i + 1]]
    home, asks = (np.flatnonzero(group.column(c).to_numpy()) for c in ("home", "asks"))
    values = [sketch_of(i) for i in home]
    owner = np.repeat(np.arange(len(home)), [len(v) for v in values])
    flat_values = np.concatenate(values) if len(home) else np.empty(0, np.int64)
    order = np.argsort(flat_values, kind="stable")
    flat_values, owner = flat_values[order], owner[order]
    tied: dict[int, int] = {}

    def root(c: int) -> int:
        while tied.get(c, c) != c:
            c = tied[c]
        return c

    out = {"a": [], "b": [], "sure": []}
    for q in asks:
        mine = sketch_of(q)
        low, high = np.searchsorted(flat_values, mine), np.searchsorted(flat_values, mine, "right")
        common = np.bincount(owner[flat(low, high - low)], minlength=len(home))
        whole = (n[home] <= WIDE) & (n[q] <= WIDE)
        linked = np.where(whole, 100 * common >= 75 * (n[home] + n[q] - common), common >= LEAST_SHARED[WIDE])
        for i in np.flatnonzero(linked & (comp[home] != comp[q])):
            x, y = root(int(comp[q])), root(int(comp[home[i]]))
            if x != y:
                out["a"].append(int(ids[q]))
                out["b"].append(int(ids[home[i]]))
                out["sure"].append(bool(whole[i]))
                if whole[i]:
                    tied[max(x, y)] = min(x, y)
    return pa.Table.from_batches([arrow(out, ACROSS)])


def last_links(listed: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """All links between classes that share a list and are still in different components.

    In each family the members outside its largest component, the asking ones, are compared with every member by
    counting. Both are dealt into blocks of about ``FAMILY``; a group is a block of each.
    """
    members = families(listed).withColumnRenamed("node", "id").withColumnRenamed("component", "fam").join(labels, "id")
    members = keep(members, f"{folder}/members")
    sizes = members.groupBy("fam", "comp").agg(F.count("*").alias("m"))
    count = lambda m: F.ceil(m / FAMILY).cast("int")
    sizes = sizes.groupBy("fam").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.sum("m").alias("m"), F.max("m").alias("most"))
    sizes = sizes.select("fam", "main", count(F.col("m")).alias("homes"), count(F.col("m") - F.col("most")).alias("askers"))
    rows = members.join(sizes, "fam").withColumn("asks", F.col("comp") != F.col("main"))
    own = F.pmod(F.xxhash64("id"), F.col("homes")).cast("int")
    rows = rows.withColumn("own", own).withColumn("turn", F.when(F.col("asks"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("askers")).cast("int")))
    pair = lambda a, h: F.struct(a.cast("int").alias("a"), h.cast("int").alias("h"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    at_home = F.transform(upto("askers"), lambda a: pair(a, F.col("own")))
    asking = F.transform(upto("homes"), lambda h: pair(F.col("turn"), h))
    rows = rows.where("askers > 0").withColumn("block", F.explode(F.when(F.col("asks"), F.array_union(at_home, asking)).otherwise(at_home)))
    rows = rows.withColumn("home", F.col("block.h") == F.col("own")).withColumn("asks", F.coalesce(F.col("block.a") == F.col("turn"), F.lit(False)))
    rows = rows.select("fam", "id", "comp", "home", "asks", F.col("block.a").alias("askers"), F.col("block.h").alias("homes"))
    rows = rows.join(sets.select("id", "n", "sketch"), "id").select("fam", "askers", "homes", "id", "comp", "n", "sketch", "home", "asks")
    found = keep(rows.groupBy("fam", "askers", "homes").applyInArrow(across, ACROSS), f"{folder}/across")
    unsure = verified(found.where("not sure").select("a", "b").distinct(), classes, sets)
    return found.where("sure").select("a", "b").unionByName(unsure)


def classes_linked(classes: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """(id, comp): the component of every class that is linked with another one."""
    suspects = prefixes(classes, K).select("id").distinct().join(classes.select("id", "cls", "row"), "id")
    texts = docs.join(suspects, "row").select("id", "cls", "text")
    sets = keep(texts.mapInArrow(full_sets, SETS).dropDuplicates(["id"]), f"{folder}/sets")
    lists = keep(prefixes(sets, WIDE), f"{folder}/lists")
    labels = keep(lists.select("id", F.col("id").alias("comp")).distinct(), f"{folder}/labels")
    for round_ in range(ROUNDS + 1):
        listed = lists.join(labels, "id")
        if round_ < ROUNDS:
            found = verified(star(listed, round_), classes, sets)
        else:
            found = last_links(listed, classes, sets, labels, folder)
        name = lambda x: labels.select(F.col("id").alias(x), F.col("comp").alias(f"c{x}"))
        edges = found.join(name("a"), "a").join(name("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b")
        edges = keep(edges.distinct(), f"{folder}/edges{round_}")
        if not edges.isEmpty():
            new = components(edges).withColumnRenamed("node", "comp")
            labels = keep(labels.join(new, "comp", "left").select("id", F.coalesce("component", "comp").alias("comp")), f"{folder}/labels{round_}")
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, first_row) for each row of ``docs`` (doc_id, text).

    ``row`` is a hash of id and text, ``first_row`` that of the component's member with the least id.
    ``component_id`` is the least doc_id that can be reached by links. A null text, or one without
    words, has no shingles and is its own component. Repeated rows are linked with one another; rows
    without a doc_id take part, and their component is null only if no member has an id.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "neardup")
    docs = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    rows = keep(docs.mapInArrow(sketch, SKETCHES), f"{folder}/rows")
    own = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("row").alias("row"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least")
    )
    classes = keep(own.withColumn("id", F.monotonically_increasing_id()), f"{folder}/classes")
    labels = classes_linked(classes, docs, folder)
    named = classes.select("id", "cls", "least").join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = named.groupBy("comp").agg(F.min("least").alias("first"))
    named = named.join(least, "comp").select("cls", "first")
    size = F.col("n").alias("n_shingles")
    some = rows.where(F.col("cls").isNotNull()).join(named, "cls")
    some = some.select("doc_id", "row", size, F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row"))
    none = rows.where(F.col("cls").isNull()).select("doc_id", "row", size, F.col("doc_id").alias("component_id"), F.col("row").alias("first_row"))
    return some.unionByName(none)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component: that of the least doc_id, repeated rows once; all columns stay."""
    found = near_duplicates(docs)
    first = found.where(F.col("row") == F.col("first_row")).select(F.col("row").alias("_row")).distinct()
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    return rows.join(first, "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")
