"""Whitening against exact and plain versions."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklode.llm import whitening
from worklode.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def exact(vectors):
    """Whole numbers, sums and covariance, all exact up to the last rounding."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    near = np.array([[n * r[j] - s[j] for j in range(d)] for r in x], dtype=object)
    v = near.T.dot(near)
    return np.array(x), s, np.array([[float(Fraction(int(c), n**3)) for c in row] for row in v]), (near * near).sum(axis=1)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x, s, v, deviation = exact([r["embedding"] for r in rows])
    n = len(x)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    got = QUERIES["op12_whitening"](spark, SF).collect()
    assert len(got) == 8 * n
    place = {r["vec_id"]: i for i, r in enumerate(rows)}
    want = (x - np.array(s) / n) @ u[:, :8] / np.sqrt(e[:8])
    found, sign = np.full((n, 8), np.nan), None
    for r in got:
        found[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[place[r["vec_id"]]]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(v), rel=1e-9)
        assert r["identity_error"] < 1e-9
    sign = np.sign((found * want).sum(axis=0))
    assert np.abs(found * sign - want).max() < 1e-8


@pytest.mark.parametrize("gaps", [[9, 5, 3, 1], [4, 4, 4, 1, 1], [4, 4 - 1e-9, 4 - 2e-9, 1], [7, 2 + 1e-6, 2, 2 - 1e-12, 0, 0]])
def test_refined_from_single_precision(gaps):
    """Clustered values too: V x = e x and orthogonality to double precision; vectors where the gap allows it."""
    d = len(gaps)
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(d, d)))[0]
    v = (q * np.array(gaps)) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.eigen(v)
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-15 * 4
    assert np.abs(v @ x - x * e).max() < 1e-15 * 8 * gaps[0]
    assert np.allclose(e, gaps, atol=1e-14 * 10)
    if len(set(gaps)) == d and min(-np.diff(gaps)) > 0.1:
        assert np.abs(np.abs((x * q).sum(axis=0)) - 1).max() < 1e-14


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [[float(x) for x in rng.normal(size=3) * [3, 2, 1]] for _ in range(60)]
    rows = list(enumerate(good)) + [(0, good[0]), (None, good[1]), (70, [1.0, 2.0]), (71, [])]
    bad = [(80, None), (81, [1.0, None, 2.0]), (82, [float("nan"), 1.0, 1.0]), (83, [1.0, float("-inf"), 0.0]), (84, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows + bad], "vec_id long, embedding array<double>, n int, component string").repartition(5)
    got = whitening.whiten(df, whitening.fit(df), k=8)
    x, s, v, deviation = exact([(v + [0.0] * 3)[:3] for _, v in rows])
    assert got.count() == 3 * len(rows) and {r[0] for r in got.select("vec_id").distinct().collect()} == {i for i, _ in rows}
    e = np.linalg.eigvalsh(v)[::-1]
    for c in got.groupBy("component").agg(F.avg(F.col("whitened") ** 2).alias("m"), F.max("explained").alias("e")).collect():
        assert c["m"] == pytest.approx(1) and c["e"] == pytest.approx(e[c["component"] - 1] / e.sum())
    assert sorted(int(r[0]) for r in got.filter("component = 1").select("deviation").collect()) == sorted(int(d) for d in deviation)


def test_without_variance(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(df, whitening.fit(df)).collect()
    assert len(got) == 18 and all((r["whitened"] is None) == (r["component"] == 2) for r in got) and got[0]["identity_error"] < 1e-12
    same = df.withColumn("embedding", F.array(F.lit(2.5), F.lit(1.0)))
    got = whitening.whiten(same, whitening.fit(same)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in got} == {(None, None, None, 0)}
    none = df.limit(0)
    assert whitening.whiten(none, whitening.fit(none)).collect() == []
    empty = df.withColumn("embedding", F.array().cast("array<float>"))
    assert whitening.whiten(empty, whitening.fit(empty)).collect() == []


def test_large_numbers_stay_exact(spark):
    df = spark.createDataFrame([(1, [1e9, 5.0]), (2, [-1e9, 7.5]), (3, [3e9, -2.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df, whitening.fit(df)).collect()}
    assert got == dict(zip((1, 2, 3), map(int, exact([[1e9, 5.0], [-1e9, 7.5], [3e9, -2.0]])[3])))
