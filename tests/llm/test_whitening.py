"""Whitening: the solver against LAPACK, the query against whole-number brute force."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm import whitening
from skytally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("spectrum", ["spread", "equal", "two", "low rank", "one large", "falling", "zero", "negative"])
@pytest.mark.parametrize("d", [1, 2, 7, 48])
def test_components_equal_lapack(spectrum, d):
    draw = np.random.default_rng(d)
    q, _ = np.linalg.qr(draw.standard_normal((d, d)))
    e = {
        "spread": draw.random(d), "equal": np.ones(d), "two": np.arange(d) % 2 + 1.0, "low rank": np.where(np.arange(d) < 3, 2.0, 0),
        "one large": np.r_[1e8, draw.random(d - 1)], "falling": 10.0 ** -np.arange(d), "zero": np.zeros(d), "negative": draw.random(d) - 0.5,
    }[spectrum]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    size = max(np.abs(e).max(), 1e-300)
    for k in (None, 3):
        values, vectors = whitening.components(a, k)
        assert np.abs(values - np.sort(np.linalg.eigvalsh(a))[::-1][: k or d]).max() < 1e-13 * size * d
        assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size * d
        assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-13 * d


def test_polar_factor():
    draw = np.random.default_rng(1)
    for n in (1, 3, 20):
        a = draw.standard_normal((n, n))
        u, s, v = np.linalg.svd(a)
        assert np.abs(whitening.polar(a) - u @ v).max() < 1e-12


def brute(rows, k=16):
    """(vec_id, component) to the exact columns and the whitened value."""
    kept = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        z = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)])
        for j in range(min(k, len(sums))):
            if values[j] > 1e-9 * values[0]:
                out.append((i, j + 1, n, deviation, float(z @ vectors[:, j] / math.sqrt(values[j])), values[j] / values.sum()))
    return out


def compare(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], round(abs(r[4]), 5))
    found = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in found), key=key)
    expected = sorted(expected, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert np.allclose([abs(r[4]) for r in found], [abs(r[4]) for r in expected], atol=1e-8)
    assert np.allclose([r[5] for r in found], [r[5] for r in expected], rtol=1e-9)
    # One sign per component for all rows.
    signs = {}
    for a, b in zip(found, expected):
        if abs(a[4]) > 1e-4:
            signs.setdefault(a[1], set()).add(a[4] * b[4] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_query_equals_brute_force(spark):
    found = QUERIES["op12_whitening"](spark, SF_DIR).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    compare(found, brute(rows))
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_edge_cases(spark):
    draw = np.random.default_rng(2)
    usable = [(k, [float(c) for c in draw.standard_normal(5)]) for k in range(40)]
    usable += [usable[3], (90, usable[4][1]), (None, usable[5][1]), (91, [0.0, -0.0, 1e-9, 5.0, 2.0])]
    rows = usable + [(50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [float("nan")] * 5), (53, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("own")).withColumn("c", F.lit(1))
    compare(whitening.whiten(frame).collect(), brute(rows))
    # Another length, nothing in it, and entries without whole numbers take no part.
    odd = spark.createDataFrame([(70, [1.0]), (71, []), (72, [1e300, 0.0, 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    compare(whitening.whiten(frame.select("vec_id", "embedding").union(odd)).collect(), brute(rows))
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.filter("vec_id = 50")).collect() == []
    assert whitening.whiten(frame.filter("vec_id = 1")).collect() == []
    # Fewer vectors than dimensions, and a constant one.
    few = [(k, [*v, 7.0]) for k, v in usable[:4]]
    found = whitening.whiten(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect()
    compare(found, brute(few))
    assert {r["component"] for r in found} == {1, 2, 3} and found[0]["identity_error"] < 1e-9


def test_deviation_beyond_a_long(spark):
    rows = [(k, [float(k) * 2**40, 1.0]) for k in range(3)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r["vec_id"], r["deviation"]) for r in found} == {(0, None), (1, 0), (2, None)}
