"""Whitening against exact fractions and a double-precision decomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tideline.llm.whitening import eigenvectors, whiten

FIELDS = "vec_id bigint, embedding array<float>"


def brute(rows, scale=256, components=4):
    """(vec_id, deviation) per row, and eigenvalues, vectors, mean of the fit list."""
    xs = []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            xs.append((i, tuple(math.floor(Fraction(float(np.float32(c))) * scale) for c in v)))
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    far = [[Fraction(x[k]) - Fraction(sums[k], n) for k in range(d)] for x in fit]
    cov = np.array([[float(sum(f[a] * f[b] for f in far) / n) for b in range(d)] for a in range(d)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    dev = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in xs]
    return xs, n, sums, dev, values[order], vectors[:, order], values.sum()


def close(spark, rows, **options):
    df = spark.createDataFrame(rows, FIELDS).repartition(3)
    found = whiten(df, **options).collect()
    xs, n, sums, dev, values, vectors, trace = brute(rows)
    k = len(values)
    assert sorted((r["vec_id"], r["component"]) for r in found) == sorted(
        (i, c) for i, _ in xs for c in range(1, k + 1)
    )
    assert {(r["vec_id"], int(r["deviation"]), r["n"]) for r in found} == {(i, v, n) for i, v in dev}
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"] - 1] = r
    for c in range(k):
        due = {i: (np.array(x) - np.array(sums) / n) @ vectors[:, c] / math.sqrt(values[c]) for i, x in xs}
        mine = {i: by[i][c]["whitened"] for i in due}
        top = max(due, key=lambda i: abs(due[i]))
        sign = 1 if due[top] * mine[top] > 0 else -1
        for i in due:
            assert math.isclose(mine[i], sign * due[i], rel_tol=1e-9, abs_tol=1e-9)
        assert all(math.isclose(by[i][c]["explained"], values[c] / trace, rel_tol=1e-10) for i in due)
    assert len({r["identity_error"] for r in found}) == 1
    assert found[0]["identity_error"] < 1e-10


def test_against_fractions(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + np.arange(6))]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # a third are copies of one vector
    rows += [(200, None), (201, []), (202, [None] * 6), (203, [float("nan")] * 6),
             (204, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0])]
    close(spark, rows)


def test_partitions_make_no_difference(spark, sample_dir):
    vectors = spark.read.parquet(f"{sample_dir}/embeddings.parquet")
    one = whiten(vectors.repartition(1)).orderBy("vec_id", "component").collect()
    many = whiten(vectors.repartition(13)).orderBy("vec_id", "component").collect()
    for a, b in zip(one, many, strict=True):
        assert a["deviation"] == b["deviation"]
        assert a["whitened"] == b["whitened"] and a["explained"] == b["explained"]


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 10, 24),
        [3, 3, 3, 1, 1],
        [2.0] * 8,
        np.r_[5 + 1e-9 * np.arange(10), 5 + 1e-6 * np.arange(1, 11), np.linspace(1, 2, 6)],
        np.r_[1e6, 1e6 * (1 + 1e-13), [1e-3] * 3, [0.0] * 15],
    ],
)
def test_clustered_eigenvalues(values):
    """Vectors are orthonormal and solve the problem far beyond what float32 can say."""
    d = len(values)
    wide = np.longdouble
    q = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0].astype(wide)
    for _ in range(3):
        q = q + q @ ((np.eye(d) - q.T @ q) / 2)
    a = (q * np.array(values, wide)) @ q.T
    a = (a + a.T) / 2
    x = eigenvectors(a)
    found = (x * (a @ x)).sum(axis=0)
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17 * np.abs(a).max()
    assert np.abs(np.sort(found) - np.sort(values)).max() < 1e-15 * max(values)
    rough = np.linalg.eigh(a.astype(np.float32))[1]
    assert np.abs(rough.T @ rough - np.eye(d)).max() > 1e-9


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**28 + i), float(-(2**30) + 3 * i)]) for i in range(50)]
    found = whiten(spark.createDataFrame(rows, FIELDS.replace("float", "double"))).collect()
    xs = [[int(c * 256) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*xs)]
    due = {i: sum((50 * c - s) ** 2 for c, s in zip(x, sums)) for i, x in enumerate(xs)}
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == due


def test_edges(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), FIELDS)
    assert whiten(make()).count() == 0
    assert whiten(make((1, None), (2, []))).count() == 0
    one = whiten(make((None, [0.5, 1.0]), (None, [0.5, 1.0]))).collect()
    assert len(one) == 4
    assert all(r["whitened"] is None and r["identity_error"] is None for r in one)
    assert {(r["n"], r["deviation"], r["explained"]) for r in one} == {(1, 0, 0.0)}
    # Two vectors differ in one direction only.
    two = whiten(make((1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0]))).collect()
    lead = {r["vec_id"]: r["whitened"] for r in two if r["component"] == 1}
    assert math.isclose(abs(lead[1]), 1) and math.isclose(lead[1], -lead[2])
    assert all(r["whitened"] is None for r in two if r["component"] > 1)
    assert two[0]["identity_error"] < 1e-12
    with pytest.raises(ValueError, match="several lengths"):
        whiten(make((1, [0.0]), (2, [0.0, 1.0])))
    with pytest.raises(Exception, match="scaled entry"):
        whiten(make((1, [3e38]))).count()


def test_clashing_columns(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 2.0], "n", 5), ("b", [2.0, 1.0], None, 6)],
        "id string, x array<double>, component string, n int",
    )
    found = whiten(df, "id", "x", components=1).collect()
    assert sorted(r["id"] for r in found) == ["a", "b"]
