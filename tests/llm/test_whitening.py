"""Whitening against whole-number arithmetic and a library's eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import whitening
from ebbline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows: list[tuple], components: int = 8) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """Deviations by place, eigenvalues, components and whitened rows of (id, vector) rows."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    w = np.array([[c / n for c in r] for r in centred]) @ vectors / np.sqrt(values)
    return [sum(c * c for c in r) for r in centred], values / v.trace(), vectors, w


def random_rows(n: int, d: int, seed: int, scale: float = 1.0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.linspace(1, 0.1, d) * scale + rng.normal(size=d)
    return [(i, [float(c) for c in r.astype(np.float32)]) for i, r in enumerate(x)]


@pytest.mark.parametrize("n, d, scale", [(300, 12, 1.0), (40, 5, 1e6), (60, 9, 1e11), (5, 30, 0.2)])
def test_equals_exact_arithmetic(spark, n, d, scale):
    rows = random_rows(n, d, n, scale)
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    deviations, shares, _, w = brute(rows, min(8, n - 1, d))
    by_place = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(by_place) == n * len(shares)
    signs = [np.sign(by_place[0, k + 1].whitened * w[0, k]) for k in range(len(shares))]
    for (i, k), r in by_place.items():
        assert (r.n, int(r.deviation)) == (n, deviations[i])
        assert abs(r.explained - shares[k - 1]) <= 1e-9 * shares[k - 1]
        assert abs(signs[k - 1] * r.whitened - w[i, k - 1]) <= 1e-7 * max(1, abs(w[i, k - 1]))
        assert r.identity_error < 1e-9


def test_factor_and_rotations_equal_a_library(spark):
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (6, 6), (33, 33), (20, 4)):
        half = rng.normal(size=(d, rank)) * np.logspace(0, -5, rank)
        v = half @ half.T
        factor = whitening.pivoted_cholesky(v)
        assert np.abs(factor @ factor.T - v).max() <= 1e-14 * np.abs(v).max() * d
        values, vectors = whitening.one_sided_jacobi(factor)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
        want = np.linalg.svd(half, compute_uv=False) ** 2
        # A product of half with itself is rounded, which moves an eigenvalue by this much.
        assert np.allclose(values[:rank], want, rtol=1e-9, atol=d * np.finfo(float).eps * want[0])
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_whole_number_scatter_is_exact_at_every_size():
    rng = np.random.default_rng(3)
    for largest in (10, 2**20, 2**26, 2**30, 2**61):
        r = rng.integers(-largest, largest, (50, 4))
        wide = r.astype(object)
        assert (whitening.exact_scatter(r) == wide.T @ wide).all()


def test_odd_vectors(spark):
    rows = random_rows(30, 3, 5)
    good = [(i, v) for i, v in rows] + [(None, rows[0][1]), (4, rows[4][1]), (4, rows[9][1]), (99, [0.0, 0.0, 0.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0]), (53, [float("inf"), 1.0, 1.0]), (54, [3e30, 1.0, 1.0]), (55, [])]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumn("label", F.lit(1))
    for i, name in enumerate(("n", "w", "d", "v", "key", "shares", "component", "deviation", "whitened")):
        df = df.withColumn(name, F.lit(i))
    found = whitening.whiten(df)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    deviations, _, _, _ = brute(good)
    first = found.where("component = 1").collect()
    assert sorted((r.vec_id or -1, int(r.deviation)) for r in first) == sorted((i or -1, d) for (i, _), d in zip(good, deviations, strict=True))
    assert {r.n for r in first} == {len(good)} and {r.component for r in found.collect()} == {1, 2, 3}


def test_dimensions_apart_equal_vectors_single_and_empty(spark):
    rows = random_rows(20, 2, 6) + [(100 + i, v) for i, v in random_rows(25, 4, 7)]
    rows += [(200 + i, [1.0, 2.0, 3.0]) for i in range(5)] + [(300, [1.0] * 7)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n, r.component) for r in found} == {(20, 1), (20, 2), (25, 1), (25, 2), (25, 3), (25, 4)}
    assert max(r.identity_error for r in found) < 1e-9
    nothing = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert nothing.count() == 0 and dict(nothing.dtypes)["whitened"] == "double"
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op11_whitening"](spark, sf)
    assert dict(found.dtypes)["deviation"] == "bigint"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    deviations, shares, _, _ = brute(rows)
    got = found.collect()
    assert len(got) == 8 * len(rows) and max(r.identity_error for r in got) < 1e-9
    assert {(r.vec_id, r.deviation) for r in got} == {(i, d) for (i, _), d in zip(rows, deviations, strict=True)}
    assert np.allclose(sorted({r.explained for r in got}, reverse=True), shares, rtol=1e-9)
