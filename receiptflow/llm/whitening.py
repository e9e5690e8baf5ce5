"""Whitening of embeddings on their leading components, by Chebyshev-filtered subspace iteration.

The covariance V of the centred vectors is never built. One pass over the vectors multiplies it by a block of a few
columns, XᵀXQ: each task centres its vectors, multiplies, and sends one row for each dimension, which Spark adds up.
From a start block of ``components + GUARD`` random columns, rounds follow one another: the three-term recurrence of
the Chebyshev polynomials of V, stretched over the unwanted part of the spectrum (from 0 to the least Ritz value),
keeps that part at most 1 and lets what lies above it grow; then QR, and Rayleigh-Ritz in the block. A round's last
product gives the residuals; it ends when those of the wanted components are as small as double precision lets them
be (``CERTIFIED`` times the largest value), or stop falling below ``TOLERATED``.

The driver holds blocks of (dimension x columns) numbers, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.components import keep
from receiptflow.llm.text import arrow, plus, schema_of
from receiptflow.session import work_folder

COMPONENTS, GUARD, DEGREE, ROUNDS = 4, 28, 10, 200
CERTIFIED, TOLERATED = 4e-15, 1e-11
SCALE = 256


@dataclass(frozen=True)
class Whitening:
    """What was fitted: vectors, their sums, components (columns) with their variances, and how good they are."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float
    residuals: np.ndarray
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.empty(0)


def whole(vector: Column, scale: int = SCALE) -> Column:
    """The entries as whole numbers, floor(scale * entry); null if the vector or an entry is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * scale)))


def usable(rows: DataFrame, column: str, scale: int = SCALE) -> DataFrame:
    """``rows`` with ``x``, without those whose vector is unusable or has another length than most (on a tie, the longest)."""
    rows = rows.withColumn("x", whole(F.col(column), scale)).where("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("x") == (usual["size"] if usual else 0))


def matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def by_dimension(rows: DataFrame, work, columns: int, kind: str) -> dict[int, list]:
    """Adds up, over all tasks, what ``work`` makes of a matrix of vectors: (dimension x columns) numbers."""
    schema = schema_of(f"place int, value {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(matrix(batch))
                total = part if total is None else total + part
        if total is not None:
            yield arrow({"place": np.arange(total.size, dtype=np.int32), "value": total.ravel()}, schema)

    parts = rows.select("x").mapInArrow(run, schema)
    wide = "decimal(38,0)" if kind == "long" else "double"
    # One number for each dimension and column reaches the driver.
    sums = dict(parts.groupBy("place").agg(F.sum(F.col("value").cast(wide))).collect())
    return {i: [sums[i * columns + j] for j in range(columns)] for i in range(len(sums) // columns)}


class Covariance:
    """Multiplies the covariance of the rows' ``x`` by blocks; counts its passes."""

    def __init__(self, rows: DataFrame, n: int, mean: np.ndarray):
        self.rows, self.n, self.mean, self.passes, self.trace = rows, n, mean, 0, 0.0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        mean, n = self.mean, self.n

        def work(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return np.column_stack([centred.T @ (centred @ block), (centred * centred).sum(axis=0)]) / n

        self.passes += 1
        sums = by_dimension(self.rows, work, block.shape[1] + 1, "double")
        out = np.array([sums[i] for i in range(len(mean))])
        self.trace = float(out[:, -1].sum())
        return out[:, :-1]


def filtered(covariance: Covariance, block: np.ndarray, product: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times ``block``, small on [0, cut], scaled to stay near 1 at ``top``."""
    centre = half = cut / 2
    first = scale = half / (top - centre)
    before, now = block, (product - centre * block) * (first / half)
    for _ in range(degree - 1):
        then = 1 / (2 / first - scale)
        before, now = now, 2 * (covariance @ now - centre * now) * (then / half) - scale * then * before
        scale = then
    return now


def leading(covariance: Covariance, size: int, components: int, guard: int, degree: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues, their vectors and residuals."""
    width = min(size, components + guard)
    block = np.linalg.qr(np.random.default_rng(0).standard_normal((size, width)))[0]
    before = np.inf
    for number in range(rounds):
        product = covariance @ block
        inner = block.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        residuals = np.linalg.norm(product - block * values, axis=0)[:components]
        worst = float(residuals.max(initial=0)) / max(values[0], np.finfo(float).tiny)
        stalled = worst <= TOLERATED and worst > before / 2
        if values[0] <= 0 or worst <= CERTIFIED or stalled or number == rounds - 1:
            break
        before = worst
        cut = min(max(values[-1], 1e-9 * values[0]), values[0])
        block = np.linalg.qr(filtered(covariance, block, product, cut, values[0], degree))[0]
    if values[0] > 0 and worst > TOLERATED:
        raise RuntimeError(f"components are not certain after {rounds} rounds: residual {worst:.1e}")
    return values[:components], block[:, :components], residuals


def fit(
    vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
    guard: int = GUARD, degree: int = DEGREE, rounds: int = ROUNDS,
) -> Whitening:
    """Fit on each distinct usable vector once (see ``usable``).

    Components without variance are left out, so there are fewer than ``components`` of them for few vectors, and none
    for no vector or a single one.
    """
    rows = usable(vectors.select(column), column, scale).select("x").distinct()
    rows = keep(rows, f"{work_folder(vectors.sparkSession, 'whitening')}/vectors")
    n = rows.count()
    totals = by_dimension(rows, lambda x: x.sum(axis=0, dtype=np.int64)[:, None], 1, "long")
    sums = [int(totals[i][0]) for i in range(len(totals))]
    mean = np.array([s / n for s in sums]) if n else np.empty(0)
    if not len(mean):
        return Whitening(n, sums, np.empty((0, 0)), np.empty(0), np.empty(0), 0.0, np.empty(0), 0)
    covariance = Covariance(rows, n, mean)
    values, block, residuals = leading(covariance, len(mean), components, guard, degree, rounds)
    some = values > len(mean) * np.finfo(float).eps * max(values[0], 0)
    values, block = values[some], block[:, some]
    if not len(values):
        return Whitening(n, sums, block, values, values, 0.0, residuals[some], covariance.passes)
    scaled = block / np.sqrt(values)
    error = np.abs(scaled.T @ (covariance @ scaled) - np.eye(len(values))).max()
    return Whitening(n, sums, block, values, values / covariance.trace, float(error), residuals[some], covariance.passes)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sums of (n x - S)² of each row; null beyond 64 bits."""
    if not len(x):
        return []
    most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    out = (sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [d if d < 1 << 63 else None for d in out]


def transform(vectors: DataFrame, model: Whitening, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The usable rows with ``x``, ``deviation`` (long) and ``whitened`` (an entry for each component).

    Rows whose vector is null, holds null or non-finite entries, or has another length than the fitted ones are left out;
    repeated rows stay. Columns that bear these three names are replaced.
    """
    rows = vectors.withColumn("x", whole(F.col(column), scale))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") == len(model.sums)))
    schema = plus(rows.schema, "x array<long>, deviation long, whitened array<double>")
    mean, n, sums = model.mean, model.n, model.sums
    scaled = model.components / np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch)
            own = {name: batch.column(name) for name in batch.schema.names}
            whitened = (x - mean) @ scaled if len(mean) else np.empty((len(x), 0))
            yield arrow(own | {"deviation": deviations(x, n, sums) if sums else [0] * len(x), "whitened": whitened.tolist()}, schema)

    return rows.mapInArrow(run, schema)
