"""Repeated strings of ``LENGTH`` bytes across documents, found with Burrows-Wheeler transforms.

Every string of LENGTH bytes has an anchor, its least hash of GRAM bytes; equal strings have equal
anchors at equal offsets. Strings in a row with the same anchor form a segment, and only segments
whose anchor gram occurs again take part:

1. Anchor grams are counted. A bit map of bounded size of those that repeat goes to all tasks; it may let
   through others, which come to nothing later.
2. Segments with such grams are gathered. Equal segments are put together first, however many there
   are: all but the first one repeat it whole.
3. Different segments of one gram meet in a bucket of some megabytes, whose suffixes are sorted. On its
   Burrows-Wheeler transform, breadth-first backward extension sets the common prefix lengths of
   neighbouring suffixes by increasing value: a boundary of value v between two suffixes gives one of
   value v + 1 between each two suffixes that extend them to the left by the same byte. It stops at
   LENGTH; where no boundary was set, neighbours share LENGTH bytes or more. Of such a class all strings
   but the first are repeats. Grams with very many different segments are taken apart by string
   instead (``CROWDED``), which meets the same strings by their hash.
4. What repeats an earlier string is cut from the documents.

First means the smaller (doc_id, position); null ids come first, equal ids go by a hash of the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import keep
from receiptflow.llm.text import arrow, bounded, mix, pieces, plus, schema_of, starts
from receiptflow.session import work_folder

LENGTH, GRAM = 100, 40
#: Strings that can have the same anchor.
REACH = LENGTH - GRAM + 1
#: The bit map has 16 bits for each repeated gram, and at most so many (16 MB).
BITS = 1 << 27
#: Bytes in a bucket, about, and different segments of a gram from which it is taken apart.
BUCKET, CROWDED = 1_500_000, 20_000

GRAMS = schema_of("gram long, n long")
SEGMENTS = schema_of("gram long, seg long, doc_id long, row long, begin int, count int, shift int, body binary")
MASKS = schema_of("gram long, seg long, mask long")
STRINGS = schema_of("gram long, seg long, at int, s1 long, s2 long, first_doc long, first_row long, first_pos long")


def words_at(buffer: bytes, offset: int, n: int) -> np.ndarray:
    """The eight bytes from each of ``n`` places on, as numbers."""
    return np.ascontiguousarray(np.ndarray((n,), "<u8", buffer, offset, (1,)))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes, np.ndarray]:
    """For each segment: document, begin, count, anchor (in the buffer); the buffer; where documents start."""
    buffer = b"".join(texts)
    begin = starts(np.array([len(t) for t in texts], np.int64))
    n = len(buffer) - GRAM + 1
    none = np.empty(0, np.int64)
    if n < REACH:
        return none, none, none, none, buffer, begin
    least = mix(words_at(buffer, 0, n) * np.uint64(0x9E3779B97F4A7C15) + words_at(buffer, GRAM - 8, n))
    # The hash, then the place: of equal hashes the leftmost is least.
    least = (least >> np.uint64(28) << np.uint64(28)) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = REACH - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    inside = np.zeros(len(least) + 1, np.int8)
    first, last = begin[:-1], begin[1:] - LENGTH + 1
    some = last > first
    np.add.at(inside, first[some], 1)
    np.add.at(inside, last[some], -1)
    place = np.flatnonzero(np.cumsum(inside[:-1]))
    anchor = (least[place] & np.uint64((1 << 28) - 1)).astype(np.int64)
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else none
    count = np.diff(np.append(new, len(anchor)))
    start = place[new]
    return np.searchsorted(begin, start, "right") - 1, start, count, anchor[new], buffer, begin


def grams_at(buffer: bytes, anchor: np.ndarray) -> np.ndarray:
    bytes_ = np.frombuffer(buffer, np.uint8)[anchor[:, None] + np.arange(GRAM)]
    out = np.zeros(len(anchor), np.uint64)
    for word in np.ascontiguousarray(bytes_).view("<u8").T:
        out = mix(out + word)
    return out


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in pieces(batches):
        *_, anchor, buffer, _ = anchors(texts)
        grams, n = np.unique(grams_at(buffer, anchor), return_counts=True)
        yield arrow({"gram": grams.astype(np.int64), "n": n}, GRAMS)


def probes(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(grams & np.uint64(bits - 1)), (grams >> np.uint64(32)) & np.uint64(bits - 1)]


def segments(bitmap, bits: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bitmap.value
        for rows, texts in pieces(batches):
            doc, start, count, anchor, buffer, begin = anchors(texts)
            grams = grams_at(buffer, anchor)
            known = np.ones(len(grams), bool)
            for p in probes(grams, bits):
                known &= (words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
            doc, start, count, anchor, grams = (x[known] for x in (doc, start, count, anchor, grams))
            ids, keys = (rows.column(c).to_pylist() for c in ("doc_id", "row"))
            shift = anchor - start
            bodies = [buffer[a : a + c + LENGTH - 1] for a, c in zip(start.tolist(), count.tolist(), strict=True)]
            seg = [xxhash.xxh3_64_intdigest(b, seed=s) for b, s in zip(bodies, shift.tolist(), strict=True)]
            yield arrow({
                "gram": grams.astype(np.int64), "seg": np.array(seg, np.uint64).astype(np.int64), "doc_id": [ids[d] for d in doc], "row": [keys[d] for d in doc],
                "begin": (start - begin[doc]).astype(np.int32), "count": count.astype(np.int32), "shift": shift.astype(np.int32), "body": bodies,
            }, SEGMENTS)

    return found


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The suffixes in order, each up to the end of its segment (symbol 0), equal ones by place.

    ``left`` is how many symbols there are up to that end.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, symbols.dtype)]).astype(np.int64)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(7):
        key = key * 512 + padded[j : j + n] * alive
        alive &= padded[j : j + n] > 0
    order = np.argsort(key, kind="stable")
    known = 7
    while True:
        new = np.append(True, key[order][1:] != key[order][:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = head
        tied = ~(new & np.append(new[1:], True))
        slots = np.flatnonzero(tied)
        mine = order[slots]
        # Suffixes that have ended by now are equal, and stay in the order of their places.
        if not len(slots) or known > left[mine].max():
            return order
        after = np.where(left[mine] > known, rank[np.minimum(mine + known, n - 1)] + 1, 0)
        # Stable: equal ones stay in the order of their places.
        both = rank[mine] * (n + 2) + after
        again = np.argsort(both, kind="stable")
        order[slots] = mine[again]
        both = both[again]
        # Order within the ties becomes part of the key: where neighbours differ a new rank begins.
        fresh = np.where(np.append(True, both[1:] != both[:-1]), slots, 0)
        key = rank
        key[mine[again]] = np.maximum.accumulate(fresh)
        known *= 2


def boundaries(symbols: np.ndarray, order: np.ndarray, ends: int, length: int) -> np.ndarray:
    """Where in ``order`` neighbouring suffixes share fewer than ``length`` symbols (the place of the later one).

    The first ``ends`` suffixes are the segments' ends, which are all different.
    """
    n = len(order)
    before = np.where(order > 0, symbols[order - 1], 0)
    back = np.argsort(before, kind="stable")
    target = np.empty(n, np.int64)
    target[back] = np.arange(n)
    same = np.append(False, before[back][1:] == before[back][:-1]) & (before[back] > 0)
    previous = np.full(n, -1, np.int64)
    previous[back[same]] = back[np.flatnonzero(same) - 1]
    leads = symbols[order]
    is_set = np.append(np.append(True, leads[1:] != leads[:-1]), True)
    is_set[: ends + 1] = True
    fresh = np.flatnonzero(is_set[:-1])
    for _ in range(length - 1):
        edges = np.flatnonzero(is_set)
        size = edges[np.searchsorted(edges, fresh) + 1] - fresh
        total = int(size.sum())
        if not total:
            break
        base = np.repeat(fresh, size)
        at = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + base
        crossing = (previous[at] >= 0) & (previous[at] < base)
        reached = target[at[crossing]]
        fresh = np.unique(reached[~is_set[reached]])
        is_set[fresh] = True
    return is_set[:-1]


def repeats(group: pa.Table) -> pa.Table:
    """For the first copy of each segment of a bucket, a bit for each string that has occurred before."""
    bodies = group.column("body").to_pylist()
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    begin = starts(sizes)
    symbols = np.zeros(begin[-1], np.int16)
    raw = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int16) + 1
    symbols[:] = raw
    symbols[begin[1:] - 1] = 0
    segment = np.repeat(np.arange(len(bodies)), sizes)
    offset = np.arange(begin[-1]) - begin[segment]
    left = sizes[segment] - 1 - offset
    order = suffix_order(symbols, left)
    edge = boundaries(symbols, order, len(bodies), LENGTH)
    least = -(1 << 63)
    first = {c: np.array([least if v is None else v for v in group.column(c).to_pylist()], np.int64) for c in ("first_pos", "first_row", "first_doc")}
    when = np.lexsort(list(first.values()))
    rank = np.empty(len(bodies), np.int64)
    rank[when] = np.arange(len(bodies))
    mine = rank[segment[order]]
    # Suffixes shorter than a string have ended: they share fewer bytes than LENGTH with any other.
    string = left[order] >= LENGTH
    group_start = np.flatnonzero(edge)
    earliest = np.minimum.reduceat(np.where(string, mine, len(bodies)), group_start)
    label = np.cumsum(edge) - 1
    again = string & (mine > earliest[label])
    mask = np.zeros(len(bodies), np.int64)
    np.bitwise_or.at(mask, segment[order][again], np.int64(1) << offset[order][again])
    hit = np.flatnonzero(mask)
    return pa.Table.from_batches([arrow({"gram": group.column("gram").combine_chunks().take(hit), "seg": group.column("seg").combine_chunks().take(hit), "mask": mask[hit]}, MASKS)])


def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of crowded segments by its hash."""
    for rows in batches:
        out: dict[str, list] = {c: [] for c in STRINGS.names}
        for r in rows.to_pylist():
            for at in range(r["count"]):
                digest = np.frombuffer(xxhash.xxh3_128_digest(r["body"][at : at + LENGTH]), np.int64)
                for name, value in zip(STRINGS.names, (r["gram"], r["seg"], at, int(digest[0]), int(digest[1]), r["first_doc"], r["first_row"], r["first_pos"] + at), strict=True):
                    out[name].append(value)
        yield arrow(out, STRINGS)


def masks(distinct: DataFrame, crowded: int) -> DataFrame:
    """(gram, seg, mask) of the segments with strings that occur in an earlier, different segment."""
    sizes = distinct.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum(F.length("body")).alias("bytes")).where("kinds > 1")
    total = sizes.where(F.col("kinds") < crowded).agg(F.sum("bytes")).first()[0] or 0
    mixed = distinct.join(sizes.select("gram", "kinds"), "gram")
    bucket = F.pmod(F.xxhash64("gram"), F.lit(max(1, -(-total // BUCKET))))
    plain = mixed.where(F.col("kinds") < crowded).withColumn("bucket", bucket)
    found = plain.groupBy("bucket").applyInArrow(repeats, MASKS)
    each = mixed.where(F.col("kinds") >= crowded).drop("kinds").mapInArrow(strings, STRINGS)
    order = F.struct("first_doc", "first_row", "first_pos")
    first = each.groupBy("s1", "s2").agg(F.min(order).alias("first"))
    late = each.join(first, ["s1", "s2"]).where(order > F.col("first"))
    return found.unionByName(late.groupBy("gram", "seg").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("mask")))


def cutter(schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            sizes = np.array([len(t) for t in texts], np.int64)
            begin = starts(sizes)
            column = rows.column("_cuts")
            doc = np.repeat(np.arange(len(texts)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            cuts = column.flatten()
            first = cuts.field("begin").to_numpy(zero_copy_only=False).astype(np.int64) + begin[doc]
            which, bit = np.nonzero((cuts.field("mask").to_numpy(zero_copy_only=False).astype(np.int64)[:, None] >> np.arange(REACH)) & 1)
            at = first[which] + bit
            edge = np.bincount(at, minlength=begin[-1] + 1) - np.bincount(at + LENGTH, minlength=begin[-1] + 1)
            gone = np.cumsum(edge)[:-1] > 0
            opens = gone & np.append(True, ~gone[:-1])[: len(gone)]
            # A document that begins with a cut opens one, whatever the one before ends with.
            heads = begin[:-1][sizes > 0]
            opens[heads] = gone[heads]
            left = np.frombuffer(b"".join(texts), np.uint8)[~gone].tobytes()
            lost, opened = starts(gone), starts(opens)
            ends = (begin - lost[begin]).tolist()
            kept = [left[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            removed, spans = np.diff(lost[begin]), np.diff(opened[begin])
            named = {f.name: rows.column(f.name) for f in schema.fields if f.name in rows.schema.names}
            yield arrow(named | {"kept": kept, "n_bytes": sizes, "n_removed": removed, "n_spans": spans}, schema)

    return cut


def without_repeats(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans`` of each row.

    Columns of these names are replaced. What is left may end within a character, so it is binary.
    A null text has no bytes. Repeated rows are one document: nothing of them is cut for the other's
    sake. Texts shorter than ``LENGTH`` bytes stay whole.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "repeats")
    texts = bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    counts = texts.select("text").mapInArrow(count_grams, GRAMS).groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    counts = keep(counts.select("gram"), f"{folder}/grams")
    bits = 1 << min(BITS.bit_length() - 1, max(10, (16 * counts.count()).bit_length()))
    probe = lambda shift: F.shiftrightunsigned("gram", shift).bitwiseAND(F.lit(bits - 1))
    places = counts.select(F.explode(F.array(probe(0), probe(32))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))
    # At most BITS / 64 rows.
    filled = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[filled.column("w").to_numpy()] = filled.column("b").to_numpy()
    shared = spark.sparkContext.broadcast(bitmap.view(np.uint64))
    found = keep(texts.mapInArrow(segments(shared, bits), SEGMENTS), f"{folder}/segments", "zstd")
    place = F.struct("doc_id", "row", (F.col("begin") + F.col("shift")).alias("at"))
    same = found.groupBy("gram", "seg").agg(F.min(place).alias("first"), F.first("body").alias("body"), F.first("count").alias("count"), F.first("shift").alias("shift"))
    distinct = keep(same.select("gram", "seg", "body", "count", F.col("first.doc_id").alias("first_doc"), F.col("first.row").alias("first_row"),
                                (F.col("first.at") - F.col("shift")).cast("long").alias("first_pos")), f"{folder}/distinct", "zstd")
    marks = keep(masks(distinct, crowded), f"{folder}/masks")
    firsts = distinct.select("gram", "seg", "first_row", F.col("first_pos").cast("int").alias("first_pos")).join(marks, ["gram", "seg"], "left")
    rows = found.select("gram", "seg", "row", "begin", "count").join(firsts, ["gram", "seg"])
    is_first = (F.col("row") == F.col("first_row")) & (F.col("begin") == F.col("first_pos"))
    all_of = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("count")) - 1
    cuts = rows.select("row", "begin", F.when(is_first, F.coalesce("mask", F.lit(0).cast("long"))).otherwise(all_of).alias("mask")).where("mask <> 0")
    cuts = cuts.groupBy("row").agg(F.collect_set(F.struct("begin", "mask")).alias("_cuts")).withColumnRenamed("row", "_row")
    joint = docs.withColumn("_row", F.xxhash64("doc_id", "text")).join(cuts, "_row", "left").drop("_row")
    schema = plus(docs.schema, "kept binary, n_bytes long, n_removed long, n_spans long")
    return joint.mapInArrow(cutter(schema), schema)
