"""Whitening against a decomposition of all rows at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x int, weight string, whitened double"


def _table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "w", 0.5) for i, v in vectors], SCHEMA)


def _vectors(seed=5, rows=300, d=6):
    dice = np.random.default_rng(seed)
    base = dice.normal(size=(rows, d)) @ np.diag(np.linspace(3, 0.5, d)) + dice.normal(size=d)
    out = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(base)]
    return out + [(1000 + i, out[7][1]) for i in range(150)] + [(7, out[7][1]), (None, out[9][1])]


def _quantised(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def test_equals_a_decomposition_of_all_rows(spark):
    vectors = _vectors()
    bad = [(2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [math.inf] * 6), (2004, [math.nan] * 6), (2005, [1.0] * 5)]
    got = whitening.whiten(_table(spark, vectors + bad), components=4).collect()
    assert len(got) == len(vectors)
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in vectors)
    x = [_quantised(v) for _, v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = np.array([[c - s / n for c, s in zip(v, sums)] for v in x])
    values, axes = np.linalg.eigh(far.T @ far / n)
    values, axes = values[::-1], axes[:, ::-1]
    expected = far @ axes / np.sqrt(values)
    exact = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    by_id = {r.vec_id: r for r in got}
    signs = np.sign(np.array(by_id[0].whitened) * expected[0, :4])
    for (i, _), row, deviation in zip(vectors, expected, exact):
        assert by_id[i].n == n and by_id[i].deviation == deviation
        assert np.allclose(by_id[i].whitened, signs * row[:4], atol=1e-8)
    assert np.allclose(got[0].explained, values[:4] / values.sum(), rtol=1e-9)
    assert got[0].identity_error < 1e-9
    long = whitening.by_component(whitening.whiten(_table(spark, vectors)))
    assert long.count() == 6 * n
    assert {r.component for r in long.select("component").distinct().collect()} == set(range(1, 7))


def test_weight_one_fits_each_vector_once(spark):
    vectors = _vectors()
    got = whitening.whiten(_table(spark, vectors), weights="one").collect()
    assert len(got) == len(vectors) and got[0].n == 300
    once = [_quantised(v) for v in {tuple(v): v for _, v in vectors}.values()]
    values = np.linalg.eigvalsh(np.cov(np.array(once, float).T, bias=True))[::-1]
    assert np.allclose(got[0].explained, values / values.sum(), rtol=1e-9)
    with pytest.raises(ValueError):
        whitening.whiten(_table(spark, vectors), weights="half")


def test_flat_and_extreme_vectors(spark):
    flat = whitening.whiten(_table(spark, [(i, [1.0, float(i % 3), 2.0]) for i in range(9)])).collect()
    assert [v is None for v in flat[0].whitened] == [False, True, True]
    assert flat[0].identity_error < 1e-12 and flat[0].explained[1] == pytest.approx(0)
    same = whitening.whiten(_table(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert all(r.whitened == [None, None] and r.deviation == 0 for r in same)
    huge = whitening.whiten(_table(spark, [(i, [3e38 * (-1) ** i, float(i)]) for i in range(4)])).collect()
    assert len(huge) == 4 and all(r.deviation is None for r in huge)
    assert whitening.by_component(whitening.whiten(_table(spark, []))).collect() == []


def test_a_hot_vector_is_spread(spark):
    many = spark.range(20_000).select(
        F.col("id").alias("vec_id"),
        F.expr("IF(id % 3 = 0, array(0.5F, 0.25F), array(CAST(id % 97 AS FLOAT), CAST(id % 89 AS FLOAT)))").alias("embedding"),
    )
    got = whitening.whiten(many).agg(F.count("*"), F.avg(F.col("whitened")[0]), F.var_pop(F.col("whitened")[1])).first()
    assert got[0] == 20_000 and abs(got[1]) < 1e-9 and got[2] == pytest.approx(1)
