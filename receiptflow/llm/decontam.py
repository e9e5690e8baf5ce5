"""Benchmark passages in documents, found with a distributed positional inverted index.

The index is sharded by document, as search engines do it: each shard holds the postings (term, then
position) of the words of some megabytes of whole documents, so neither a frequent word nor a large
corpus makes any list or task large, and building it needs no shuffle. A shard is one row of a
Parquet table, which answers any number of benchmarks.

Test items are hashed on Spark and written as blocks, one Parquet row each. A search reads the shards
against one block at a time; the driver holds only the hashed words of that one, and tasks cut it into windows. In each shard a window begins with the
list of its rarest term; the lists of its other terms, from rare to frequent, are intersected with
what is left after their offsets are taken off. What survives all terms is an exact phrase match;
what stays within ``slop`` positions of each offset is a proximity match.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import keep
from receiptflow.llm.text import Hashes, arrow, bounded, flat, joined, pieces, schema_of, starts
from receiptflow.session import work_folder

SHARD = schema_of("shard string, keys array<string>, lengths binary, terms binary, ends binary, positions binary")
TESTS = schema_of("block string, names array<string>, lengths binary, words binary")
FOUND = schema_of("shard string, doc int, key string, n_words long, spans array<span>, items array<string>, near array<string>")
#: Bytes of test text, about, in a block; larger benchmarks are searched block by block.
BLOCK = 8 << 20
#: Bytes of text, about, that a shard holds.
SIZE = 4 << 20

_kept = [i for i in range(256) if i >= 128 or chr(i).isascii() and chr(i).isalnum()]
#: Word bytes, lower-cased; all else becomes a space.
WORDS = bytes(ord(chr(i).lower()) if i < 128 and i in _kept else i if i in _kept else 32 for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def steps(positions: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The positions of each term as steps from one to the next, the first from 0; they compress better."""
    out = np.diff(positions, prepend=np.int32(0))
    out[ends[:-1]] = positions[ends[:-1]]
    return out


def places(stepped: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What ``steps`` came from."""
    total = np.cumsum(stepped, dtype=np.int64)
    first = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
    return (total - np.repeat(total[first] - stepped[first], np.diff(np.append(first, len(stepped))))).astype(np.int32)


def index_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for rows, texts in pieces(batches, size=SIZE):
        words = [hashes.of(words_of(text)) for text in texts]
        lengths = np.array([len(w) for w in words], np.int32)
        tokens = joined(words)
        order = np.argsort(tokens, kind="stable").astype(np.int32)
        terms, first = np.unique(tokens[order], return_index=True)
        ends = np.append(first[1:], len(tokens)).astype(np.int32) if len(terms) else np.empty(0, np.int32)
        blobs = [b.tobytes() for b in (lengths, terms, ends, steps(order, ends))]
        row = [uuid.uuid4().hex, rows.column("_key").to_pylist(), *blobs]
        yield arrow({name: [value] for name, value in zip(SHARD.names, row, strict=True)}, SHARD)


def build_index(docs: DataFrame, key: str = "doc_id") -> str:
    """Write the positional index of all words of all texts; returns its folder.

    ``key`` names the column a document is reported by. A null text has no words. Repeated rows are
    documents of their own.
    """
    path = work_folder(docs.sparkSession, "positions")
    bounded(docs).select(F.col(key).cast("string").alias("_key"), "text").mapInArrow(index_shards, SHARD).write.parquet(path, compression="zstd")
    return path


def test_blocks(size: int, block: int):
    """Packs the word hashes of items into rows of about ``block`` bytes of text.

    Longer items are cut into runs that share ``size`` - 1 words, so that each window is in one. Items
    without words are left out.
    """
    longest = max(2 * size, block // 4)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, names, runs, held = Hashes(), [], [], 0

        def row() -> pa.RecordBatch:
            lengths = np.array([len(r) for r in runs], np.int64)
            return arrow({"block": [uuid.uuid4().hex], "names": [names], "lengths": [lengths.tobytes()], "words": [joined(runs).tobytes()]}, TESTS)

        for rows, texts in pieces(batches):
            for name, text in zip(rows.column("item_id").to_pylist(), texts, strict=True):
                words = hashes.of(words_of(text))
                for start in range(0, max(1, len(words) - size + 1) if len(words) else 0, longest - size + 1):
                    names.append(name)
                    runs.append(words[start : start + longest])
                    held += min(len(text), 8 * len(runs[-1]))
                    if held >= block:
                        yield row()
                        names, runs, held = [], [], 0
        if runs:
            yield row()

    return packed


def test_windows(lengths: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term hashes of all windows of some items end to end, the windows' lengths, and the item of each.

    An item of fewer than ``size`` words is one window.
    """
    counts = np.maximum(1, lengths - size + 1)
    owner = np.repeat(np.arange(len(lengths)), counts)
    widths = np.minimum(size, lengths)[owner]
    return words[flat(flat(starts(lengths)[:-1], counts), widths)], widths, owner


def matches(terms, ends, positions, doc_of, tests, lengths, slop):
    """Windows that occur: (window, start) of exact matches, then of proximity matches."""
    begin = starts(lengths)
    at = np.searchsorted(terms, tests)
    known = (at < len(terms)) & (terms[np.minimum(at, max(0, len(terms) - 1))] == tests) if len(terms) else np.zeros(len(tests), bool)
    all_known = np.logical_and.reduceat(known, begin[:-1]) if len(lengths) else np.empty(0, bool)
    live = np.flatnonzero(all_known)
    if not len(live):
        nothing = (np.empty(0, np.int64), np.empty(0, np.int64))
        return nothing, nothing
    firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    counts = ends - firsts
    # Postings in one ascending list: term number, then position.
    postings = (np.repeat(np.arange(len(terms), dtype=np.int64), counts) << 32) | positions
    # The terms of each window from rare to frequent, as rows of offsets.
    width = int(lengths[live].max())
    slots = np.arange(width)
    inside = slots < lengths[live][:, None]
    cell = np.where(inside, begin[live][:, None] + slots, 0)
    term = at[cell]
    rank = np.argsort(np.where(inside, counts[term], 1 << 40), axis=1, kind="stable")
    head = term[np.arange(len(live)), rank[:, 0]]
    window = np.repeat(np.arange(len(live)), counts[head])
    start = positions[flat(firsts[head], counts[head])].astype(np.int64) - rank[window, 0]
    last = start + lengths[live][window] - 1
    fits = (start >= 0) & (last < len(positions))
    window, start, last = window[fits], start[fits], last[fits]
    whole = doc_of[start] == doc_of[last]
    window, start = window[whole], start[whole]
    exact = np.ones(len(window), bool)
    for step in range(1, width):
        offset = rank[window, step]
        used = inside[window, offset]
        key = (term[window, offset].astype(np.int64) << 32) | (start + offset)
        near = np.searchsorted(postings, key - slop)
        hit = np.minimum(near, len(postings) - 1)
        # The term within slop of its offset, and in the same document.
        close = (near < len(postings)) & (postings[hit] <= key + slop) & (doc_of[postings[hit] & 0xFFFFFFFF] == doc_of[start])
        there = np.searchsorted(postings, key)
        same = (there < len(postings)) & (postings[np.minimum(there, len(postings) - 1)] == key)
        exact &= same | ~used
        keep = close | same | ~used
        window, start, exact = window[keep], start[keep], exact[keep]
    return (live[window[exact]], start[exact]), (live[window[~exact]], start[~exact])


def by_name(names: set[str | None]) -> list[str | None]:
    """Names in order, null last, as ``array_sort`` has them."""
    return sorted(names, key=lambda name: (name is None, name or ""))


def search_shards(tests: tuple[list, bytes, bytes], size: int, slop: int, everything: bool):
    """Finds a block in each shard; documents without hits as well if ``everything``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, *binaries = tests
        hashes, lengths, owner = test_windows(*(np.frombuffer(x, t) for x, t in zip(binaries, (np.int64, np.uint64), strict=True)), size)
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["lengths"], np.int32)
                terms, ends = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["ends"], np.int32)
                positions = places(np.frombuffer(row["positions"], np.int32), ends)
                begin = starts(sizes)
                doc_of = np.repeat(np.arange(len(sizes)), sizes)
                (window, start), (near, near_start) = matches(terms, ends, positions, doc_of, hashes, lengths, slop)
                spans: dict[int, set] = {}
                items: dict[int, set] = {}
                close: dict[int, set] = {}
                for w, s in zip(window.tolist(), start.tolist(), strict=True):
                    doc = int(doc_of[s])
                    spans.setdefault(doc, set()).add((s - int(begin[doc]), int(lengths[w])))
                    items.setdefault(doc, set()).add(names[owner[w]])
                for w, s in zip(near.tolist(), near_start.tolist(), strict=True):
                    close.setdefault(int(doc_of[s]), set()).add(names[owner[w]])
                docs = range(len(sizes)) if everything else sorted({*spans, *close})
                yield arrow({
                    "shard": [row["shard"]] * len(docs), "doc": list(docs), "key": [row["keys"][d] for d in docs], "n_words": sizes[list(docs)].astype(np.int64),
                    "spans": [[{"start": a, "words": n} for a, n in sorted(spans.get(d, ()))] for d in docs],
                    "items": [by_name(items.get(d, set())) for d in docs],
                    "near": [by_name(close.get(d, set()) - items.get(d, set())) for d in docs],
                }, FOUND)

    return search


def covered(spans: Column) -> Column:
    """How many words some spans, in order of their starts, cover together."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def take(state: Column, span: Column) -> Column:
        end = span["start"] + span["words"]
        more = F.greatest(F.lit(0), end - F.greatest(state["end"], span["start"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["total"] + more).alias("total"))

    return F.aggregate(spans, zero, take)["total"].cast("long")


def search(spark, index: str, items: DataFrame, size: int = 10, slop: int = 2, block: int = BLOCK) -> DataFrame:
    """What of ``items`` (item_id, text) each indexed document contains.

    One row per document: ``key`` (its id as a string), ``n_words``, ``n_hit`` (words inside exact
    matches), ``spans`` (start and length of each match, in words), ``items`` (ids, as sorted strings,
    of items with exact matches) and ``near`` (ids of items with proximity matches alone). Items
    are searched in blocks of about ``block`` bytes of text, one after another; what a block finds is written
    before the next one is read. An item without an id is a null, after all others. Items without words, or with a null text, match nothing; repeated items count once.
    """
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block) or 1
    shards, folder = spark.read.schema(SHARD).parquet(index), work_folder(spark, "tests")
    tests = keep(bounded(rows).repartition(blocks).mapInArrow(test_blocks(size, block), TESTS), f"{folder}/blocks")
    # One short id for each block.
    ids = [r[0] for r in tests.select("block").collect()]

    def hits(number: int) -> DataFrame:
        one = tests.where(F.col("block") == ids[number]).first() if ids else ("", [], b"", b"")
        return shards.mapInArrow(search_shards((one[1], bytes(one[2]), bytes(one[3])), size, slop, number == 0), FOUND)

    if len(ids) < 2:
        found = hits(0)
    else:
        for number in range(len(ids)):
            keep(hits(number), f"{folder}/found/part={number}")
        found = spark.read.schema(FOUND).parquet(f"{folder}/found").select(*FOUND.names)
        union = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("spans", "items", "near")]
        found = found.groupBy("shard", "doc", "key", "n_words").agg(*union).withColumn("near", F.array_except("near", "items"))
    return found.select("key", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", "items", "near")


def contaminated(docs: DataFrame, items: DataFrame, size: int = 10, slop: int = 2) -> DataFrame:
    """``search`` over an index of ``docs``, with ``doc_id`` in its own type in the place of ``key``.

    A null doc_id stays null. A document without words, or with a null text, has no hits.
    """
    found = search(docs.sparkSession, build_index(docs), items, size, slop)
    kind = docs.schema["doc_id"].dataType
    return found.withColumn("doc_id", F.col("key").cast(kind)).drop("key")


def clean(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` that hold no window of ``items``, with all their columns."""
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = search(docs.sparkSession, build_index(rows, "_row"), items, size)
    bad = found.where("n_hit > 0").select(F.col("key").cast("long").alias("_row"))
    return rows.join(bad, "_row", "left_anti").drop("_row")
