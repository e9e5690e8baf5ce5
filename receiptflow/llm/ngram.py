"""Stupid-backoff language model scores of documents, from bigram and word counts over all of them.

A word w after u scores ln(c(uw) / c(u)) if the pair was counted at least ``LEAST`` times, else
ln(0.4 c(w) / N); the first word of a document always backs off. Words are lower-cased (A-Z) runs of
other than white space. Scores are added up as whole millionths, so the sum depends on no order.

Documents are read once, in batches of ``SIZE`` bytes that are written as packed words. A batch asks
for the counts of its distinct words and bigrams: their hashes, in order, go to the buckets they fall
into, one packed row a bucket, and the buckets send the counts back in the same order, without the
hashes. Batch and counts then meet, and each of its documents is summed up at once. What travels is
in proportion to the text at any size and any number of buckets, words and documents; a bigram has one
entry a batch, however frequent it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import keep
from receiptflow.llm.text import Hashes, arrow, bounded, flat, joined, mix, pieces, schema_of, starts
from receiptflow.session import work_folder

LEAST, BACKOFF, MICRO = 2, 0.4, 1e6
#: Entries in a bucket of words, and of bigrams, at most, about; and bytes of text in a batch.
VOCABULARY, BUCKET, SIZE = 2_000_000, 4_000_000, 8 << 20
#: Kept for callers that set it: no bigram is set apart, as none has more than one entry a batch.
HEAVY = 1000

WORDS = schema_of("batch long, n_words long, n_distinct long, body binary")
PACKED = schema_of("batch long, bucket int, body binary")
SUMS = schema_of("doc_id long, n_words long, n_hit long, micro long")


def words_of(text: bytes, hashes: Hashes) -> np.ndarray:
    return hashes.of(text.lower().split())


def pairs_of(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all bigrams of documents laid end to end, and the place of each one's second word."""
    second = flat(starts(lengths)[:-1] + 1, np.maximum(0, lengths - 1))
    return mix(tokens[second - 1] * np.uint64(0x9E3779B97F4A7C15) + tokens[second]), second


def micros(x: np.ndarray) -> np.ndarray:
    return np.rint(np.log(x) * MICRO).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal or unequal length, compressed by byte planes."""
    planes = [np.int64(len(a)).tobytes() + a.dtype.str.encode().ljust(8) + a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join(planes), 1)


def unpack(body: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(body), 0, []
    while at < len(data):
        n, kind = int(np.frombuffer(data, np.int64, 1, at)[0]), np.dtype(data[at + 8 : at + 16].decode().strip())
        at += 16
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of documents as packed words: ids, lengths, distinct words by falling frequency, and each word's place there."""
    hashes, docs, ids, first, size = Hashes(), [], [], None, 0

    def packed() -> pa.RecordBatch:
        distinct, place, n = np.unique(joined(docs), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        known = np.array([i is not None for i in ids], np.uint8)
        lengths = np.array([len(w) for w in docs], np.int64)
        body = pack(np.array([i or 0 for i in ids], np.int64), known, lengths, distinct[order], rank[place])
        return arrow({"batch": [first], "n_words": [len(place)], "n_distinct": [len(distinct)], "body": [body]}, WORDS)

    for rows, texts in pieces(batches):
        if first is None:
            first = rows.column("row")[0].as_py()
        ids += rows.column("doc_id").to_pylist()
        docs += [words_of(t, hashes) for t in texts]
        size += sum(map(len, texts))
        # Empty texts count as a byte.
        if size + len(ids) >= SIZE:
            yield packed()
            docs, ids, first, size = [], [], None, 0
    if ids:
        yield packed()


def batch_of(body: bytes) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, lengths, sorted distinct words and each word's place there, as ``read_words`` has packed them."""
    ids, known, lengths, distinct, place = unpack(body)
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)], lengths, distinct[order], rank[place]


def dealt(hashes: np.ndarray, counts: np.ndarray, buckets: int, first: int) -> Iterator[tuple[int, bytes]]:
    """Sorted hashes and their counts, packed for the buckets that they fall into: even ranges, numbered from ``first``."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
    for start, end in zip(cuts, cuts[1:]):
        yield first + int(bucket[start]), pack(np.diff(hashes[start:end], prepend=np.uint64(0)), counts[start:end].astype(np.uint32))


def ask(word_buckets: int, pair_buckets: int):
    """Each batch's distinct words and bigrams, with their counts in the batch, by bucket: first those of words."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for batch, body in zip(rows.column("batch").to_pylist(), rows.column("body"), strict=True):
                _, lengths, distinct, place = batch_of(body.as_py())
                grams, n = np.unique(pairs_of(distinct[place], lengths)[0], return_counts=True)
                out = [*dealt(distinct, np.bincount(place, minlength=len(distinct)), word_buckets, 0), *dealt(grams, n, pair_buckets, word_buckets)]
                yield arrow({"batch": [batch] * len(out), "bucket": [k for k, _ in out], "body": [x for _, x in out]}, PACKED)

    return asked


def count(group: pa.Table) -> pa.Table:
    """The counts in all batches of what a bucket was asked for, in the order of each batch's row."""
    asked = [unpack(body.as_py()) for body in group.column("body")]
    _, entry = np.unique(np.concatenate([np.cumsum(deltas) for deltas, _ in asked]), return_inverse=True)
    counts = np.bincount(entry, np.concatenate([n for _, n in asked])).astype(np.int64)[entry]
    cuts = starts(np.array([len(n) for _, n in asked]))
    bodies = [pack(counts[a:b]) for a, b in zip(cuts, cuts[1:])]
    return pa.Table.from_batches([arrow({"batch": group.column("batch").combine_chunks(), "bucket": group.column("bucket").combine_chunks(), "body": bodies}, PACKED)])


def add_up(total: int, word_buckets: int):
    """The sums of a batch's documents, from its words (bucket -1) and the counts that the buckets have sent back."""

    def summed(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        bucket, bodies = group.column("bucket").to_numpy(), [body.as_py() for body in group.column("body")]
        ids, lengths, distinct, place = batch_of(bodies[0])
        counts = [unpack(body)[0] for body in bodies[1:]]
        n_words = int(np.count_nonzero(bucket[1:] < word_buckets))
        seen, pairs = joined(counts[:n_words], np.int64), joined(counts[n_words:], np.int64)
        grams, second = pairs_of(distinct[place], lengths)
        known, gram = np.unique(grams, return_inverse=True)
        if len(seen) != len(distinct) or len(pairs) != len(known):
            raise ValueError(f"batch {group.column('batch')[0]}: {len(seen)} counts for {len(distinct)} words, {len(pairs)} for {len(known)} bigrams")
        value = micros(BACKOFF * seen / total)[place]
        hit = np.zeros(len(place), np.int64)
        of = second[pairs[gram] >= LEAST]
        value[of] = micros(pairs)[gram[pairs[gram] >= LEAST]] - micros(seen)[place[of - 1]]
        hit[of] = 1
        begin = starts(lengths)
        per_document = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[begin])
        return pa.Table.from_batches([arrow({"doc_id": ids, "n_words": lengths, "n_hit": per_document(hit), "micro": per_document(value)}, SUMS)])

    return summed


def score(docs: DataFrame, vocabulary: int = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_hit, micro, score) of every row of ``docs`` by the model of all of them.

    ``n_hit`` words were scored by their bigram; the score is a mean logarithm per word. A text without words, or a
    null one, has the sum 0 and a null score. Repeated rows count, and are scored, each. ``vocabulary`` only decides
    into how many buckets words are dealt: there are about so many in one.
    """
    folder = work_folder(docs.sparkSession, "ngrams")
    docs = bounded(docs).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Written once, so that batches are the same wherever they are read again.
    words = keep(docs.mapInArrow(read_words, WORDS), f"{folder}/words")
    total, distinct = words.agg(F.sum("n_words"), F.sum("n_distinct")).first()
    total, word_buckets, pair_buckets = total or 1, -(-(distinct or 1) // vocabulary), -(-(total or 1) // BUCKET)
    counts = words.select("batch", "body").mapInArrow(ask(word_buckets, pair_buckets), PACKED).groupBy("bucket").applyInArrow(count, PACKED)
    both = words.select("batch", F.lit(-1).alias("bucket"), "body").unionByName(counts)
    sums = both.groupBy("batch").applyInArrow(add_up(total, word_buckets), SUMS)
    mean = F.when(F.col("n_words") > 0, F.col("micro") / MICRO / F.col("n_words"))
    return sums.select("doc_id", "n_words", "n_hit", "micro", mean.alias("score"))
