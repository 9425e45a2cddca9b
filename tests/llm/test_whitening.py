"""Whitening against the eigenvectors of numpy."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries
from corpusloom.llm.spectrum_whitening import _exact_gram, above, inertia, leading_eigenpairs, whiten

ROOT = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_inertia_counts_signs(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = rng.standard_normal((n, n))
        a = a + a.T
        np.fill_diagonal(a, rng.choice([0.0, 1.0], n) * a.diagonal())
        w = np.linalg.eigvalsh(a)
        assert inertia(a)[0] == (w > 0).sum() and inertia(a)[2] == (w < 0).sum()
        assert above(a, 0.3) == (w > 0.3).sum()


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_eigenpairs(n):
    rng = np.random.default_rng(n)
    for _ in range(10):
        x = rng.standard_normal((n + 4, n)) * rng.random(n)
        v = (x.T @ x) / len(x)
        got = leading_eigenpairs(v, 4)
        assert np.allclose([p[0] for p in got], np.linalg.eigvalsh(v)[::-1][:4], rtol=1e-10)
        for value, vector in got:
            assert np.linalg.norm(v @ vector - value * vector) < 1e-12 * np.abs(v).sum()


def test_equal_close_and_zero_eigenvalues():
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))[0]
    for diagonal, count in (([3, 3, 3, 1, 0, 0], 4), ([1, 1 - 1e-15, 1 - 1e-9, 0.5, 0.1, 0.1], 4), ([7] * 6, 4), ([2, 0, 0, 0, 0, 0], 1), ([0] * 6, 0)):
        got = leading_eigenpairs(q @ np.diag(np.array(diagonal, float)) @ q.T, 4)
        assert np.allclose([p[0] for p in got], diagonal[:count]) and len(got) == count
        if count:
            m = np.stack([p[1] for p in got])
            assert np.abs(m @ m.T - np.eye(count)).max() < 1e-12


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for high in (9, 1 << 20, 1 << 31):
        y = rng.integers(-high, high, (300, 3))
        o = y.astype(object)
        assert (_exact_gram(y) == o.T @ o).all()


def expected(ids, vectors, components=4):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True).reshape(x.shape[1], -1)
    w, u = np.linalg.eigh(v)
    out = {}
    for key, row in zip(ids, x):
        for c in range(components):
            value = (row - sums / n) @ u[:, -1 - c] / math.sqrt(w[-1 - c])
            out.setdefault((key, c + 1), []).append((n, int(((n * row - sums) ** 2).sum()), value, w[-1 - c] / v.trace()))
    return out


def compare(rows, want):
    signs = {}
    assert sum(map(len, want.values())) == len(rows)
    for r in rows:
        n, deviation, value, share = want[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["explained"] - share) <= 1e-9 * share and r["identity_error"] < 1e-9
        assert abs(abs(r["whitened"]) - abs(value)) < 1e-8 * max(1, abs(value))
        if abs(value) > 1e-6:
            signs.setdefault(r["component"], set()).add(r["whitened"] * value > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_registered_query(spark):
    rows = pq.read_table(f"{ROOT}/embeddings.parquet").to_pylist()
    want = expected([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    got = queries.op12(spark, ROOT).collect()
    compare(got, want)


def test_unusable_rows_ties_and_other_columns(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    good += [(i + 100, v) for i, v in good[:25]] + [(None, good[3][1])]
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [math.nan] + [0.0] * 4), (203, [math.inf] + [0.0] * 4), (204, []), (205, [1.0, 2.0]), (206, [1e300] * 5)]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({"_x": F.lit(1), "_id": F.lit("q"), "component": F.lit(3), "a`b": F.lit(0)}).repartition(5)
    got = whiten(df).withColumnRenamed("_id", "vec_id").collect()
    want = expected([k for k, _ in good], [v for _, v in good])
    assert {r["vec_id"] for r in got} == {k for k, _ in good}
    compare(got, want)
    again = whiten(df.repartition(3)).withColumnRenamed("_id", "vec_id").collect()
    assert sorted(map(repr, [r[:6] for r in got])) == sorted(map(repr, [r[:6] for r in again]))


def test_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    got = whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in got)
