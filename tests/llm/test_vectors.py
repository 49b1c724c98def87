"""Whitening and exact search: against numpy and all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from titlecorpus.llm import inner_product, whitening

NAN, INF = float("nan"), float("inf")
SHAPE = "vec_id long, embedding array<float>, score string, x string, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SHAPE)


def check_whitening(got, rows):
    """``rows``: the usable (id, vector) of the input."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for _, v in rows], object)
    fit = np.array(sorted({tuple(v) for v in x}), object)
    n, sums = len(fit), fit.sum(0)
    centred = ((n * fit - sums) / n).astype(float)
    cov = centred.T @ centred / n
    e = np.linalg.eigh(cov)[0][::-1]
    k = min(16, int((e > 1e-9 * e[0]).sum()))
    assert len(got) == len(rows) * k
    deviation = sorted((i, int(((n * v - sums) ** 2).sum())) for (i, _), v in zip(rows, x))
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-4 for r in got)
    share = {r.component: r.explained for r in got}
    assert np.allclose([share[j + 1] for j in range(k)], e[:k] / e.sum(), rtol=1e-6)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r.whitened
    first = {i: np.array([by[i][j + 1] for j in range(k)]) for i in by}
    once = {tuple(v): first[i] for (i, _), v in zip(rows, x)}
    w = np.array([once[tuple(v)] for v in fit])
    assert np.allclose(w.T @ w / n, np.eye(k), atol=1e-6) and np.allclose(w.mean(0), 0, atol=1e-6)
    # Components are eigenvectors: the covariance of x with the component is e times it.
    loading = centred.T @ w / n / np.sqrt(e[:k])
    assert np.allclose(cov @ loading, loading * e[:k], atol=1e-6 * e[0]) and np.allclose((loading**2).sum(0), 1, atol=1e-6)


@pytest.mark.parametrize("band", [whitening.BAND, 60])
def test_whitening_of_the_table(spark, band):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(4)
    check_whitening(whitening.digest(df, band).collect(), [(r.vec_id, r.embedding) for r in df.collect()])


def test_whitening_of_odd_vectors(spark):
    r = np.random.default_rng(3)
    good = [(i, [float(np.float32(c)) for c in r.normal(size=4)]) for i in range(30)]
    good += [(100 + i, good[0][1]) for i in range(40)]  # a hot vector
    bad = [(200, None), (201, [NAN, 1.0, 1.0, 1.0]), (202, [INF, 1.0, 1.0, 1.0]), (203, [1.0, None, 1.0, 1.0]), (204, []), (205, [1.0])]
    check_whitening(whitening.digest(frame(spark, good + bad)).collect(), good)


def test_whitening_without_variance(spark):
    flat = [(i, [float(i % 3), 1.0, 2.0 * (i % 3)]) for i in range(9)]
    got = whitening.digest(frame(spark, flat)).collect()
    assert len(got) == 9 and {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        empty = whitening.digest(frame(spark, rows))
        assert empty.count() == 0 and [f.name for f in empty.schema] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    huge = whitening.digest(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (None, [0.0, 3.0])])).collect()
    # Three times 2^62 fits no long; the row in the middle has small distances.
    assert {(r.vec_id, r.deviation) for r in huge} == {(1, None), (2, None), (None, 320**2)}


def brute_products(rows, k=10):
    """{(query, vector): [(id, score)]} by all pairs; equal rows count once."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            every = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
            out.setdefault(q, []).append([(i, -s) for s, i in every[:k]])
    return {q: sorted(x) for q, x in out.items()}


def found_products(df, **kw):
    found = {}
    for r in inner_product.search(df, F.col("vec_id") % 100 == 0, **kw).orderBy("row", "rank").collect():
        found.setdefault((r.query_id, r.row), []).append((r.vec_id, r.score))
    out = {}
    for (q, _), x in found.items():
        out.setdefault(q, []).append(x)
    return {q: sorted(x) for q, x in out.items()}


@pytest.mark.parametrize("kind", ["uniform", "lengths", "sharp", "integers"])
def test_products_equal_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(inner_product, "SEEDS", 40)
    monkeypatch.setattr(inner_product, "BLOCK", 64)
    monkeypatch.setattr(inner_product, "QUERIES", 3)
    r = np.random.default_rng(7)
    x = r.normal(size=(900, 6)) * 1000
    if kind == "lengths":
        x *= np.exp(r.normal(size=(900, 1)) * 2)
    if kind == "sharp":
        x = r.normal(size=(30, 6))[r.integers(0, 30, 900)] * 1000 + r.normal(size=(900, 6)) * 5
    if kind == "integers":
        x = r.integers(-1, 2, size=(900, 3))
    rows = [(int(i), [int(c) for c in np.floor(v)]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<long>")
    assert found_products(df) == brute_products(rows)


def test_block_looks_by_length_and_by_coordinates():
    r = np.random.default_rng(11)
    x = (r.normal(size=(500, 8)) * 500).astype(np.int64)
    length = np.sqrt((x.astype(float) ** 2).sum(1))
    block = inner_product.Block(np.arange(500), x, length)
    for cosine in (0.2, 0.75, 0.95):
        q = (r.normal(size=8) * 300).astype(np.int64)
        near = set(np.flatnonzero(block.directions @ (q / np.linalg.norm(q)) >= cosine))
        at = block.by_coordinates(q.astype(float), cosine)
        assert near <= set(at.tolist())
    assert len(at) < 500 and block.by_length(0) == 500 and 0 < block.by_length(float(np.median(length))) < 260
    scores = x @ q
    for least in np.sort(scores)[[-3, -60]]:
        _, j, s = block.best(np.array([-1]), q[None, :], np.array([np.linalg.norm(q)]), np.array([float(least)]), 10)
        assert sorted(s.tolist(), reverse=True) == sorted(scores[scores >= least].tolist(), reverse=True)[:10]


def test_products_of_odd_vectors(spark):
    rows = [(0, [1, 0]), (100, [0, 2]), (1, [1, 0]), (2, [2, 0]), (3, [1, 1]), (5, [0, 0]), (200, [0, 0]), (0, [1, 0]), (300, [5, 5]), (300, [-5, 5]), (7, [1, 0])]
    bad = [(4, None), (8, [1, None]), (9, [1, 2, 3]), (None, [1, 0]), (10, [])]
    df = spark.createDataFrame([(*x, "a", "b", 1) for x in rows + bad], "vec_id long, embedding array<long>, row string, least string, id long")
    assert found_products(df) == brute_products(rows)
    assert found_products(df, k=2) == brute_products(rows, 2)
    assert inner_product.search(df.limit(0), F.lit(True)).count() == 0
    floats = frame(spark, [(0, [0.5, -0.001]), (1, [NAN, 1.0]), (2, [INF, 1.0]), (3, [0.25, 1.0])])
    assert [tuple(r) for r in inner_product.whole_vectors(floats).collect()] == [(0, [512, -2]), (3, [256, 1024])]


def test_products_of_large_numbers(spark):
    big = 1 << 40
    rows = [(0, [big, 1]), (1, [1 << 20, 5]), (2, [3, 4]), (3, [big, big])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<long>")
    got = found_products(df)[0][0]
    assert got == [(3, (1 << 63) - 1), (1, (1 << 60) + 5), (2, 3 * big + 4)]


def test_products_of_a_hot_vector(spark):
    rows = [(i, [3, 4] if i % 3 == 0 else [i % 7, -(i % 5)]) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<long>")
    assert found_products(df) == brute_products(rows)
