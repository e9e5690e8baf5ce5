"""Whitening against an eigendecomposition of the whole covariance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from receiptflow.llm import whitening

VECTORS = "vec_id long, embedding array<double>"


def plain(x, components):
    fitted = np.unique(x, axis=0)
    centred = fitted - fitted.sum(axis=0) / len(fitted)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fitted))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return len(fitted), fitted.sum(axis=0), (x - fitted.sum(axis=0) / len(fitted)) @ vectors / np.sqrt(values), values


def data(spark, vectors):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], VECTORS)


@pytest.mark.parametrize("shape", [(400, 40), (60, 20), (200, 3), (30, 2)])
def test_components_equal_the_eigenvectors(spark, shape):
    r = np.random.default_rng(shape[0])
    vectors = r.standard_normal(shape) @ np.diag(np.linspace(1, 2, shape[1]))
    vectors = np.concatenate([vectors, vectors[:7], np.repeat(vectors[:1], 50, axis=0)])
    df = data(spark, vectors).repartition(6)
    model = whitening.fit(df)
    x = np.floor(vectors * 256).astype(np.int64)
    n, sums, expected, values = plain(x, 4)
    assert model.n == n and model.sums == sums.tolist() and len(model.variances) == min(4, shape[1])
    assert np.allclose(model.variances, values, rtol=1e-12) and model.identity_error < 1e-12
    rows = {r["vec_id"]: r for r in whitening.transform(df, model).collect()}
    assert len(rows) == len(vectors)
    found = np.array([rows[i]["whitened"] for i in range(len(vectors))])
    for j in range(found.shape[1]):
        assert min(abs(found[:, j] - expected[:, j]).max(), abs(found[:, j] + expected[:, j]).max()) < 1e-10
    assert [rows[i]["deviation"] for i in range(len(x))] == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for v in x]


def test_close_values_take_many_rounds(spark):
    """The filter works where one start block does not hold the answer."""
    r = np.random.default_rng(5)
    vectors = r.standard_normal((300, 60))
    model = whitening.fit(data(spark, vectors), guard=2, degree=8)
    _, _, _, values = plain(np.floor(vectors * 256).astype(np.int64), 4)
    assert model.passes > 20 and np.allclose(model.variances, values, rtol=1e-12)


def test_unusable_vectors_go(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [-1.0, 0.5], [-1.0, 0.5]]
    odd = [None, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0], [1.0, 2.0, 3.0], []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(good + odd)], VECTORS).withColumns({n: F.lit("mine") for n in ("x", "whitened", "deviation", "size", "value", "dimension")})
    model = whitening.fit(df)
    rows = whitening.transform(df, model)
    assert model.n == 3 and {r["vec_id"] for r in rows.collect()} == {0, 1, 2, 3} and rows.count() == 4
    assert {r["size"] for r in rows.collect()} == {"mine"}
    assert rows.where("vec_id = 3").first()["x"] == [-256, 128]


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]]])
def test_too_few_vectors_have_no_components(spark, vectors):
    df = data(spark, vectors)
    model = whitening.fit(df)
    assert len(model.variances) == 0
    rows = whitening.transform(df, model).collect()
    assert len(rows) == len(vectors) and all(r["whitened"] == [] and r["deviation"] == 0 for r in rows)


def test_directions_without_variance_are_left_out(spark):
    vectors = [[a, 2.0 * a, 1.0, 0.0] for a in (0.0, 1.0, 5.0, 9.0)]
    model = whitening.fit(data(spark, vectors))
    assert len(model.variances) == 1 and model.explained[0] == pytest.approx(1)


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 0], [1, 0]])
    assert whitening.deviations(x, 1 << 20, [0, 0]) == [None, 1 << 40]
