"""Toxicity by a support vector machine on a gap-weighted string kernel.

Two windows of text are similar by the subsequences of four to six characters that they share, white
space among them, in which at most one character is leapt over, at the weight ``DECAY``; so a window with
``idxiot`` or ``id iot`` is near one with ``idiot``. A window has ``BEGINS`` places where subsequences
begin and the characters they reach; as all windows have as many, their own similarity counts as the
same for all, which normalises the kernel. Subsequences are told apart by a hash of ``BITS`` bits. Text
is lower-cased, without punctuation, digits within words read as the letters they stand for, runs of
single letters as one word.

The machine is trained on the distinct sentences of labelled documents, which take their documents' labels.
A toxic document has at least one toxic window, a clean one none. Each round takes a document's worst windows,
of up to ``WINDOWS`` sentences, as examples (of a toxic one those that count as toxic, and its worst), fits a
linear machine with squared hinge loss on the windows' similarities to landmark windows (Nyström), and
looks for the worst windows anew. The first round goes by how unlike the toxic and clean sentences' shares
of each subsequence are. Landmarks are drawn from the examples, and their number grows with the sample.
As similarity is linear in the weighted subsequences, a machine is one weight for each subsequence.

A document's score is a logistic function that rises with the decisions of its worst ``WINDOWS`` windows, and
takes nothing else; it is fitted on labelled documents that the machine was not trained on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import keep
from receiptflow.llm.text import arrow, bounded, flat, pieces, schema_of, starts
from receiptflow.llm.training import SAMPLE, labelled
from receiptflow.session import work_folder

DECAY, LENGTHS, SPAN, BEGINS = 0.7, (4, 5, 6), 7, 5
#: Windows of a document, apart from each other, that its score is made from.
WINDOWS = 4
WIDTH = BEGINS + SPAN - 1
SENTENCES = schema_of("doc_id long, label int, number long, sentence binary")
SHARES = schema_of("key int, toxic long, clean long")
WORST = schema_of("doc_id long, label int, decision double, number long, window binary")
SIGNS = schema_of("label int, x array<double>")
SCORES = schema_of("doc_id long, score double")
#: Landmarks by the root of the number of labelled documents, rounds of examples, penalty.
LANDMARKS, ROUNDS, RIDGE = 16, 3, 0.004
#: Every so-manieth labelled document is for the logistic function alone, not for the machine.
ASIDE = 4
#: Standard errors from which a subsequence's shares count as unlike in the first round.
UNLIKE = 3.0

#: Letters are 1 to 26, 27 is white space, 28 all else in ASCII, 29 to 31 bytes of other letters; 0 is no character.
BITS, BLANK = 20, 27
#: Characters that are worked on at a time.
BLOCK = 1 << 14
CODES = bytes(
    ord(chr(i).lower()) - 96 if i < 128 and chr(i).isalpha() else BLANK if i in b" \t\n\x0b\x0c\r" else 28 if i < 128 else 29 + i % 3 for i in range(256)
)
PUNCTUATION = bytes(i for i in range(33, 128) if not chr(i).isalnum())
SPELL = bytes.maketrans(b"0134578", b"oieastb")
MIXED = re.compile(rb"(?<![a-z])[a-z]++[0134578][a-z0-9]*|[0134578]++[a-z][a-z0-9]*")
LETTERS = re.compile(rb"(?<!\S)(?:[a-z0-9]\s+){2,}[a-z0-9](?!\S)")
BLANKS = re.compile(rb"\s+")
#: What a text holds (the second, with white space at both ends) if the two above it match anywhere; quick to look for.
MAY_MIX = re.compile(rb"[0134578](?:(?=[a-z])|(?<=[a-z].))")
MAY_SPELL = re.compile(rb"\s[a-z0-9]\s+[a-z0-9]\s+[a-z0-9]\s")
SENTENCE = re.compile(rb"[.!?\n]+")
#: Where a subsequence's characters are, counted from its first.
PATTERNS = [(*inner, last) for n in LENGTHS for last in (n - 1, n) for inner in combinations(range(1, last), n - 2)]
WEIGHTS = np.array([DECAY ** (p[-1] - len(p)) for p in PATTERNS])
WEIGHTS /= np.sqrt(BEGINS * (WEIGHTS**2).sum())


def coded(text: bytes) -> bytes:
    """The characters of a text as the kernel sees them, with white space at both ends."""
    plain = text.lower().translate(None, PUNCTUATION)
    if MAY_SPELL.search(b" " + plain + b" "):
        plain = LETTERS.sub(lambda m: BLANKS.sub(b"", m[0]), plain)
    if MAY_MIX.search(plain):
        plain = MIXED.sub(lambda m: m[0].translate(SPELL), plain)
    words = plain.split()
    return b" ".join([b"", *words, b""] if words else [b"", b""]).translate(CODES)


def hashed(key: np.ndarray) -> np.ndarray:
    """A number from 1 to below 2^BITS for each subsequence, given as the run of its characters' codes."""
    key = key * np.uint32(0x9E3779B1)
    key >>= np.uint32(32 - BITS)
    return np.maximum(key, 1, out=key)


def keys_of(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each pattern, the subsequences that begin at each but the last ``SPAN`` - 1 characters of the last axis.

    0 stands for those that go beyond the text's end. Patterns share what they begin with.
    """
    n = codes.shape[-1] - SPAN + 1
    runs = {(): codes[..., :n]}
    ends = {last: codes[..., last : n + last] == 0 for last in {p[-1] for p in PATTERNS}}
    for pattern in PATTERNS:
        for i, at in enumerate(pattern):
            if pattern[: i + 1] not in runs:
                run = runs[pattern[:i]] << np.uint32(5)
                run |= codes[..., at : n + at]
                runs[pattern[: i + 1]] = run
        keys = hashed(runs[pattern])
        keys[ends[pattern[-1]]] = 0
        yield keys


def blocks(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of some coded texts, each with the characters that its last subsequences reach, and where it begins.

    What is worked out for a stretch stays in the processor's cache.
    """
    for start in range(0, len(codes) - SPAN + 1, BLOCK):
        yield start, codes[start : start + BLOCK + SPAN - 1]


def laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Coded texts end to end, with room between them that no window crosses, and where each begins."""
    at = starts(np.array([max(0, len(t) - WIDTH) + 2 * WIDTH for t in texts], np.int64))
    return np.frombuffer(b"".join(t.ljust(WIDTH, b"\0") + bytes(WIDTH) for t in texts), np.uint8).astype(np.uint32), at[:-1]


def window_sums(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decisions, without the shift, of all windows of some coded texts, text by text, and how many each has."""
    codes, at = laid(texts)
    total = np.zeros(len(codes) - SPAN + 2)
    for start, part in blocks(codes):
        sums = total[start + 1 : start + 1 + BLOCK]
        for keys, weight in zip(keys_of(part), WEIGHTS, strict=True):
            # All keys are in range; without the check for it this takes half the time.
            sums += weight * weights.take(keys, mode="clip")
    total = np.cumsum(total)
    sums = total[BEGINS:] - total[:-BEGINS]
    lengths = np.array([max(1, len(t) - WIDTH + 1) for t in texts])
    return sums[flat(at, lengths)], lengths


def decisions(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decision of the worst window of each coded text, without the shift, and where it begins."""
    if not texts:
        return np.empty(0), np.empty(0, np.int64)
    inside, lengths = window_sums(texts, weights)
    first = starts(lengths)[:-1]
    worst = np.maximum.reduceat(inside, first)
    hits = np.flatnonzero(inside == np.repeat(worst, lengths))
    _, one = np.unique(np.searchsorted(first, hits, side="right") - 1, return_index=True)
    return worst, hits[one] - first


def signs(texts: list[bytes], machine: Machine) -> np.ndarray:
    """The worst window's decision, and how far the next worst ones, apart from it and each other, are above -1 in all."""
    out = np.zeros((len(texts), 2))
    if not texts:
        return out
    inside, lengths = window_sums(texts, machine.weights)
    inside = np.clip(inside + machine.shift, -3, 3)
    first = starts(lengths)[:-1]
    out[:, 0] = np.maximum.reduceat(inside, first)
    for row, begin, n in zip(out, first.tolist(), lengths.tolist(), strict=True):
        own = inside[begin : begin + n].copy()
        for turn in range(WINDOWS):
            at = int(own.argmax())
            if own[at] <= -1:
                break
            row[1] += (own[at] + 1) * (turn > 0)
            own[max(0, at - WIDTH) : at + WIDTH] = -3
    return out


def entries(windows: list[bytes]) -> np.ndarray:
    """The subsequences of each window, pattern by pattern; those beyond a short text's end are -1."""
    codes = np.frombuffer(b"".join(w.ljust(WIDTH, b"\0") for w in windows), np.uint8).astype(np.uint32).reshape(-1, WIDTH)
    keys = np.concatenate(list(keys_of(codes)), axis=1).astype(np.int32)
    return np.where(keys > 0, keys, -1)


VALUES = np.repeat(WEIGHTS, BEGINS)


def kernel(some: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The similarity of each window with each landmark, both given by their entries."""
    m, width = marks.shape
    order = np.argsort(marks, axis=None, kind="stable")
    known, owner, value = marks.ravel()[order], order // width, VALUES[order % width]
    out = np.zeros((len(some), m), np.float32)
    for start in range(0, len(some), 256):
        block = some[start : start + 256].ravel()
        low, high = np.searchsorted(known, block), np.searchsorted(known, block, side="right")
        count = np.where(block < 0, 0, high - low)
        met = flat(low, count)
        cell = np.repeat(np.arange(len(block)) // width * m, count) + owner[met]
        rows = len(block) // width
        out[start : start + rows] = np.bincount(cell, np.repeat(np.tile(VALUES, rows), count) * value[met], rows * m).reshape(rows, m)
    return out


class Machine:
    """A weight for each subsequence, fitted on toxic and clean windows, and a shift."""

    def __init__(self, toxic: list[bytes], clean: list[bytes], landmarks: int):
        draw = np.random.default_rng(11)
        good, bad = entries(toxic), entries(clean)
        half = [e[np.sort(draw.permutation(len(e))[: max(1, landmarks // 2)])] for e in (good, bad)]
        marks = np.unique(np.concatenate(half), axis=0)
        values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
        root = vectors / np.sqrt(np.maximum(values, 1e-4))
        z = np.ones((len(good) + len(bad), len(marks) + 1), np.float32)
        for start in range(0, len(z), 2048):
            z[start : start + 2048, :-1] = kernel(np.concatenate([good, bad])[start : start + 2048], marks) @ root
        y = np.where(np.arange(len(z)) < len(good), 1.0, -1.0)
        cost = np.where(y > 0, 1 / len(good), 1 / len(bad)).astype(np.float32)
        ridge = np.diag(np.append(np.full(z.shape[1] - 1, RIDGE / len(good) ** 0.5), 1e-9))
        now, active = np.zeros(z.shape[1]), np.ones(len(z), bool)
        for _ in range(20):
            left, right = ridge.copy(), np.zeros(len(ridge))
            # In parts, so that no second copy of all examples is made.
            for start in range(0, len(z), 2048):
                used = np.flatnonzero(active[start : start + 2048]) + start
                rows = z[used] * cost[used][:, None]
                left += rows.T @ z[used]
                right += rows.T @ y[used]
            now = np.linalg.solve(left, right)
            # In parts again: the product would make a copy of all examples in double precision.
            before, active = active, y * np.concatenate([z[start : start + 2048] @ now for start in range(0, len(z), 2048)]) < 1
            if (before == active).all():
                break
        # Clean windows beyond the margin have no part in the fit.
        self.hard = [w for w, a in zip(clean, active[len(good) :], strict=True) if a]
        self.shift = float(now[-1])
        self.weights = np.bincount(np.where(marks < 0, 0, marks).ravel(), ((root @ now[:-1])[:, None] * VALUES).ravel(), 1 << BITS)
        self.weights[0] = 0
        self.weights = self.weights.astype(np.float32)


class Judge:
    """A machine, and the logistic function of a document's signs, which rises with each of them."""

    def __init__(self, machine: Machine | None = None):
        self.machine, self.usable = machine, machine is not None

    def calibrate(self, x: np.ndarray, label: np.ndarray) -> None:
        """Fit the logistic function by Newton's steps."""
        z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        w = np.zeros(z.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            curve = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
            w = w + np.linalg.solve(curve, z.T @ (label - p) - 1e-2 * w)
        self.slopes, self.level = np.maximum(w[:-1], 0), float(w[-1])

    def toxic(self, texts: list[bytes]) -> np.ndarray:
        if not self.usable or not texts:
            return np.zeros(len(texts))
        some = [coded(t) for t in texts]
        away = signs(some, self.machine) @ self.slopes + self.level
        return np.where([len(t) >= min(LENGTHS) for t in some], 1 / (1 + np.exp(-np.clip(away, -500, 500))), 0.0)


def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The coded sentences of each document, with a hash that tells them apart."""
    for rows, texts in pieces(batches):
        out: dict[str, list] = {name: [] for name in SENTENCES.names}
        for key, label, text in zip(rows.column("doc_id").to_pylist(), rows.column("label").to_pylist(), texts, strict=True):
            for sentence in {coded(s) for s in SENTENCE.split(text)}:
                if len(sentence) >= min(LENGTHS):
                    row = (key, label, xxhash.xxh64_intdigest(sentence) >> 1, sentence)
                    for name, value in zip(SENTENCES.names, row, strict=True):
                        out[name].append(value)
        yield arrow(out, SENTENCES)


def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean sentences hold each subsequence."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for rows, texts in pieces(batches, "sentence"):
        toxic = rows.column("label").to_numpy() != 0
        # Sentences go side by side, as many at a time as fill a block.
        ends = np.cumsum([len(t) for t in texts]) // BLOCK
        for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1):
            codes, at = laid([texts[i] for i in some])
            begins = np.flatnonzero(codes[: len(codes) - SPAN + 1])
            owner = (np.searchsorted(at, begins, side="right") - 1 + some[0]) << BITS
            held = np.sort(np.concatenate([owner | keys[begins] for keys in keys_of(codes)]))
            held = held[np.diff(held, prepend=-1) > 0]
            for label, row in enumerate(counts):
                np.add.at(row, held[toxic[held >> BITS] == label] & (1 << BITS) - 1, 1)
    counts[:, 0] = 0
    held = np.flatnonzero(counts.any(0))
    yield arrow({"key": held, "toxic": counts[1, held], "clean": counts[0, held]}, SHARES)


def worst_windows(weights: np.ndarray):
    """Finds each sentence's worst window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches, "sentence"):
            value, at = decisions(texts, weights)
            windows = [t[i : i + WIDTH] for t, i in zip(texts, at.tolist(), strict=True)]
            yield arrow({"doc_id": rows.column("doc_id"), "label": rows.column("label"), "number": rows.column("number"), "decision": value, "window": windows}, WORST)

    return find


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Judge:
    """Learn from the sentences of at most ``sample`` labelled training documents.

    ``WINDOWS`` + 1 windows of each of these documents and round and a count of each subsequence (of 2^20) reach the
    driver, no more. A sentence that several documents of one label hold counts once. Without labelled sentences of both
    kinds nothing is toxic.
    """
    path = work_folder(docs.sparkSession, "sentences")
    rows = labelled(bounded(docs), labels, "toxic", sample).mapInArrow(sentences, SENTENCES)
    every = keep(rows.dropDuplicates(["number", "label"]), path)
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(ASIDE)) == 0
    rows = every.where(~aside)
    sizes = {r["label"]: (r["n"], r["docs"]) for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs")).collect()}
    if not {0, 1} <= sizes.keys():
        return Judge()
    (n_clean, _), (n_toxic, _) = sizes[0], sizes[1]
    counts = rows.mapInArrow(shares, SHARES).groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = (F.col("toxic") + F.col("clean")) / (n_clean + n_toxic)
    error = F.sqrt(share * (1 - share) * (1 / n_clean + 1 / n_toxic)) + 1e-12
    unlike = (F.col("toxic") / n_toxic - F.col("clean") / n_clean) / error - UNLIKE
    # Only the subsequences that count reach the driver, as columns.
    first = counts.select("key", unlike.alias("unlike")).where("unlike > 0").toArrow()
    weights = np.zeros(1 << BITS, np.float32)
    weights[first.column("key").to_numpy()] = first.column("unlike").to_numpy()
    landmarks = int(np.ceil(LANDMARKS * np.sqrt(sum(d for _, d in sizes.values()))))

    def worst() -> list:
        """The worst windows of each document, each from another sentence, and its first window by a hash."""
        found = rows.mapInArrow(worst_windows(weights), WORST).groupBy("doc_id", "label")
        windows = F.sort_array(F.collect_list(F.struct("decision", "number", "window")), asc=False)
        return found.agg(F.slice(windows, 1, WINDOWS).alias("windows"), F.min_by("window", "number").alias("other")).collect()

    clean: set[bytes] = set()
    shift = 0.0
    for turn in range(ROUNDS):
        toxic = set()
        for r in worst():
            # Besides the worst window those that the machine calls toxic, at first those half as bad as the worst.
            least = -shift if turn else r["windows"][0]["decision"] / 2
            some = [bytes(w["window"]) for i, w in enumerate(r["windows"]) if i == 0 or not r["label"] or w["decision"] > least]
            (toxic if r["label"] else clean).update(some if r["label"] else [*some, bytes(r["other"])])
        machine = Machine(sorted(toxic), sorted(clean), landmarks)
        clean, weights, shift = set(machine.hard), machine.weights, machine.shift
    judge = Judge(machine)
    taken = labelled(docs, labels, "toxic", sample)
    kept = taken.where(aside)
    if kept.select("label").distinct().count() < 2:
        kept = taken

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            yield arrow({"label": rows.column("label"), "x": list(signs([coded(t) for t in texts], machine))}, SIGNS)

    found = kept.mapInArrow(judged, SIGNS).collect()
    judge.calibrate(np.array([r["x"] for r in found]), np.array([r["label"] for r in found]))
    return judge


def score(docs: DataFrame, judge: Judge) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; a null or empty text has the score 0."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            yield arrow({"doc_id": rows.column("doc_id"), "score": judge.toxic(texts)}, SCORES)

    return bounded(docs).select("doc_id", "text").mapInArrow(judged, SCORES)
