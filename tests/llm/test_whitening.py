import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import whitening as w


def exact(rows):
    """x, n, exact deviation of each id, the covariance by fractions, and its largest components by another solver."""
    x = {i: [math.floor(1024 * c) + 100000 for c in v] for i, v in rows}
    n, sums = len(x), [sum(c) for c in zip(*x.values(), strict=True)]
    y = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in x.values()], object)
    cov = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in y.T.dot(y)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    return dict(zip(x, (int((v**2).sum()) for v in y), strict=True)), cov, values, (y.astype(float) / n) @ vectors / np.sqrt(np.maximum(values, 1e-300)), n


def check(got, rows):
    dev, cov, values, white, n = exact(rows)
    k = min(8, len(values))
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
    assert set(by) == set(dev) and all(set(m) == set(range(1, k + 1)) for m in by.values())
    found = np.array([[by[i][c]["whitened"] for c in range(1, k + 1)] for i in dev])
    sign = np.sign((found * white[:, :k]).sum(axis=0))
    assert np.abs(found * sign - white[:, :k]).max() < 1e-8


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 150])
def test_eigen(n):
    rng = np.random.default_rng(n)
    x, (q, _) = rng.normal(size=(n, n)), np.linalg.qr(rng.normal(size=(n, n)))
    some = [x + x.T, np.eye(n) * 3, np.zeros((n, n)), np.ones((n, n)), x[: max(1, n // 3)].T @ x[: max(1, n // 3)], np.diag(np.arange(n) // 2.0)]
    some += [q * np.repeat(rng.normal(size=n), 4)[:n] @ q.T, q * 10.0 ** -np.arange(n) @ q.T, 1e200 * (x + x.T), 1e-200 * (x @ x.T)]
    for a in some:
        a = (a + a.T) / 2
        values, vectors = w.eigen(a)
        size = np.abs(a).max() or 1.0
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * n * size and (np.diff(values) <= 0).all()
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * n * size


@pytest.mark.parametrize("t", [1e-100, 1e-155, 1e-158, 1e-160, 1e-162, 1e-170, 1e-250, 1e-310])
def test_eigen_where_squares_underflow(t):
    x = np.random.default_rng(8).normal(size=(9, 9))
    edge, block = np.diag(np.arange(1.0, 10)), np.eye(10)
    edge[0, 1:] = edge[1:, 0] = t * np.arange(1, 9)
    block[1:, 1:] = t * (x + x.T)
    for a in (edge, block):
        values, vectors = w.eigen(a)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-12 and (np.diff(values) <= 0).all()
        assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-12


def test_double_double_keeps_what_doubles_lose():
    rng = random.Random(5)
    a = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-8, 8) for _ in range(1000)]
    high, low = w.sum_pairs((np.array(a)[:, None], np.zeros((1000, 1))))
    assert abs(w.fraction_of(high[0], low[0]) - sum(map(Fraction, a))) < Fraction(1, 10**20)
    p, e = w.two_product(np.array(a), np.array(a[::-1]))
    assert all(Fraction(x) * Fraction(y) == w.fraction_of(h, r) for x, y, h, r in zip(a, a[::-1], p, e, strict=True))
    s, e = w.two_sum(np.array(a), np.array(a[::-1]))
    assert all(Fraction(x) + Fraction(y) == w.fraction_of(h, r) for x, y, h, r in zip(a, a[::-1], s, e, strict=True))


def test_covariance_far_from_zero(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, (500, 4)) + 2.0**50
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(7)
    n, sums = w.vector_sums(df, "v")
    high, low = w.covariance(df, "v", n, sums)
    whole = [[int(c) for c in v] for v in x]
    y = [[c - Fraction(sum(of), 500) for c, of in zip(v, zip(*whole, strict=True), strict=True)] for v in whole]
    for i in range(4):
        for j in range(4):
            want = sum(v[i] * v[j] for v in y) / 500
            assert abs(w.fraction_of(high[i, j], low[i, j]) - want) <= Fraction(1, 10**25)


def embeddings(spark, folder, rows, more=""):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c in more.split():
        df = df.withColumn(c, F.lit("mine"))
    df.write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return [r.asDict() for r in w.op13_query(spark, str(folder)).collect()]


def test_query(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=10).astype(np.float32).tolist()) for i in range(300)] + [(500, [0.0] * 10)]
    bad = [(900, None), (901, [None] + [1.0] * 9), (902, [float("nan")] * 10), (903, [float("inf")] + [0.0] * 9), (904, []), (905, [1.0, 2.0])]
    check(embeddings(spark, tmp_path, good + bad, "x whitened deviation n"), good)
    few = [(i, v[:3]) for i, v in good]
    check(embeddings(spark, tmp_path, few), few)


def test_repeats_flat_and_empty_tables(spark, tmp_path):
    rng = np.random.default_rng(4)
    base = [(i, rng.normal(size=2).tolist()) for i in range(50)]
    flat = [(i, [v[0], v[1], v[0], 1.0]) for i, v in base]
    got = embeddings(spark, tmp_path, flat + flat)
    assert len(got) == 2 * 100 and {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-9
    assert embeddings(spark, tmp_path, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance, no component
    assert embeddings(spark, tmp_path, [(1, None)]) == [] and embeddings(spark, tmp_path, []) == []


def test_deviation_beyond_a_long(spark):
    rows = [(k, [k * 10**13, -k]) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    out, _ = w.whiten(df, "v", prepared=F.col("v"))
    sums = [sum(v[i] for _, v in rows) for i in (0, 1)]
    assert {r["id"]: int(r["deviation"]) for r in out.collect()} == {k: sum((39 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for k, v in rows}
