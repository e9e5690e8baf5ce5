"""A quality score learned from preference pairs.

The Bradley-Terry model: of two documents the one marked good is preferred, and the chance of that is
the logistic of the difference of their scores. A score is linear in statistics of the text and their
squares, so the model is a logistic regression, without intercept, on differences of features. The
threshold is the quantile of the training scores at the share of documents that are not marked good.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from receiptflow.llm.rules import CAPITALS, CONTINUED, PUNCTUATION, SYMBOLS, share
from receiptflow.llm.text import SPACE, arrow, bounded, pieces, schema_of
from receiptflow.llm.training import SAMPLE, labelled

FEATURES = schema_of("label int, x array<double>")
SCORES = schema_of("doc_id long, score double")
DIGITS = b"0123456789"
STATISTICS = 14
#: Preference pairs learned from, penalty, and the score of a document at the threshold.
PAIRS, RIDGE, AT_THRESHOLD = 40_000, 1e-3, 0.3


def features(text: bytes) -> list[float]:
    """Statistics of a text; all zero without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    chars = len(text.translate(None, SPACE + CONTINUED))
    part = lambda some: share(len(text) - len(text.translate(None, some)), len(text))
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    base = [np.log1p(n), np.log(chars / n), part(SYMBOLS), part(PUNCTUATION), part(CAPITALS), part(DIGITS)]
    base += [share(sum(a == b for a, b in zip(words, words[1:], strict=False)), n), np.log(len(counts)) / np.log(n + 1)]
    base += [share(max(counts.values()), n), share(len(lines) - len(set(lines)), len(lines)), np.log1p(n / len(lines))]
    return [*base, share(text.count(b"|"), n), share(text.count(b"!"), n), share(sum(map(len, words)) - chars, len(text))]


def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in pieces(batches):
        yield arrow({"label": rows.column("label"), "x": [features(t) for t in texts]}, FEATURES)


class Ranking:
    """A fitted score: ``rank(features)`` gives numbers between 0 and 1."""

    def __init__(self, x: np.ndarray, label: np.ndarray, pairs: int = PAIRS):
        self.usable = len(set(label.tolist())) == 2
        if not self.usable:
            return
        self.middle, self.scale = x.mean(0), x.std(0) + 1e-6
        z = self.expand(x)
        draw = np.random.default_rng(7)
        better, worse = (draw.choice(np.flatnonzero(label == k), pairs) for k in (1, 0))
        d = z[better] - z[worse]
        w = np.zeros(d.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            slope = d.T @ (1 - p) / pairs - RIDGE * w
            curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(len(w))
            w = w + np.linalg.solve(curve, slope)
        self.weights = w
        scores = z @ w
        self.threshold = float(np.quantile(scores, (label == 0).mean()))

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.scale, -8, 8)
        return np.concatenate([z, z * z], axis=1)

    def rank(self, x: np.ndarray) -> np.ndarray:
        if not self.usable or not len(x):
            return np.full(len(x), 0.5)
        away = self.expand(x) @ self.weights - self.threshold + np.log(AT_THRESHOLD / (1 - AT_THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(away, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """Learn from at most ``sample`` labelled training documents; only their statistics reach the driver."""
    rows = labelled(bounded(docs), labels, "quality", sample).mapInArrow(featured, FEATURES).collect()
    return Ranking(np.array([r["x"] for r in rows]).reshape(len(rows), STATISTICS), np.array([r["label"] for r in rows]))


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; a null text counts as empty.

    A model that saw fewer than two classes scores 0.5 everywhere.
    """

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            yield arrow({"doc_id": rows.column("doc_id"), "score": model.rank(np.array([features(t) for t in texts]))}, SCORES)

    return bounded(docs).select("doc_id", "text").mapInArrow(rank, SCORES)
