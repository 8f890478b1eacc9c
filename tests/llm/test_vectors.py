"""Whitening against a dense eigensolver, top-k search against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from knownby.llm import jacobi_davidson, voronoi_knn
from knownby.llm.vectors import inner_products

SCHEMA = "vec_id bigint, embedding array<float>, label int, x array<double>, cell int, qid string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, [1.0], 3, "q", "c") for i, v in rows], SCHEMA)


def clustered(n, width=12, clusters=5, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((clusters, width)) * 3
    out = centers[rng.integers(0, clusters, n)] + rng.standard_normal((n, width)) * 0.4
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(out)]


def usable(rows, scale):
    width = max([len(v) for _, v in rows if v is not None] or [0])
    found = []
    for i, v in rows:
        if v is not None and all(e is not None and math.isfinite(e) for e in v):
            found.append((i, [math.floor(scale * float(np.float32(e))) for e in v] + [0] * (width - len(v))))
    return found


ODD = [
    (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, float("nan"), 2.0]), (5, [float("inf"), 0.0, 1.0]),
    (6, [0.5, -0.25, 1.0]), (6, [0.5, -0.25, 1.0]), (7, [0.5, -0.25, 1.0]), (None, [0.5, -0.25, 1.0]), (100, [0.5, -0.25, 1.0]),
    (200, [0.1, 0.2]), (200, [-0.7, 0.2, 0.3]), (300, [-0.0, 0.0, 0.0]), (0, [0.001, -0.001, 0.9]), (-100, [2.0, 1.0, -1.0]), (None, [9.0, 1.0, 1.0]),
]


def check_whitening(spark, rows, at_most=4):
    got = jacobi_davidson.whiten(frame(spark, rows)).collect()
    own = usable(rows, 256)
    fit = np.unique(np.array([x for _, x in own]), axis=0)
    n, s = len(fit), [int(v) for v in fit.sum(0)]
    centred = fit - fit.sum(0) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(at_most, int((values > values[0] * 1e-12).sum()))
    assert len(got) == len(own) * count
    expected, found = [], []
    for i, x in own:
        deviation = sum((n * v - t) ** 2 for v, t in zip(x, s))
        for k in range(count):
            expected.append((str(i), k + 1, n, deviation, abs(float((np.array(x) - fit.sum(0) / n) @ vectors[:, k] / values[k] ** 0.5))))
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-10)
        assert r["identity_error"] < 1e-10
        found.append((str(r["vec_id"]), r["component"], r["n"], r["deviation"], abs(r["whitened"])))
    expected.sort()
    found.sort()
    assert [e[:4] for e in expected] == [f[:4] for f in found]
    assert np.allclose([e[4] for e in expected], [f[4] for f in found], rtol=0, atol=1e-8)
    by_row = {}
    for r in got:
        by_row.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    return by_row


def test_whitening_against_a_dense_solver(spark):
    check_whitening(spark, clustered(300))
    hot = clustered(60)
    check_whitening(spark, hot + [(1000 + i, hot[7][1]) for i in range(200)])


def test_whitening_of_odd_rows(spark):
    check_whitening(spark, ODD)


def test_whitening_without_spread(spark):
    assert jacobi_davidson.whiten(frame(spark, [])).count() == 0
    assert jacobi_davidson.whiten(frame(spark, [(1, None)])).count() == 0
    assert jacobi_davidson.whiten(frame(spark, [(1, []), (2, [])])).count() == 0
    assert jacobi_davidson.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = [(i, [float(i), 2.0 * i]) for i in range(5)]
    assert {r["component"] for r in jacobi_davidson.whiten(frame(spark, line)).collect()} == {1}


def test_whitening_of_huge_entries_counts_exactly(spark):
    rows = [(i, [float(i * 2.0**40), 1.0 * i]) for i in range(4)]
    got = {r["vec_id"]: r["deviation"] for r in jacobi_davidson.whiten(frame(spark, rows)).where("component = 1").collect()}
    assert got == {i: None for i in range(4)}
    rows = [(i, [float(i * 2.0**18), 1.0 * i]) for i in range(4)]
    got = {r["vec_id"]: r["deviation"] for r in jacobi_davidson.whiten(frame(spark, rows)).where("component = 1").collect()}
    assert got == {i: sum((4 * i * a - 6 * a) ** 2 for a in (2**26, 256)) for i in range(4)}


@pytest.mark.parametrize("width", [3, 40, 250])
def test_leading_pairs_beyond_the_search_space(width):
    """Also spaces that are cut back, close eigenvalues, and low rank."""
    rng = np.random.default_rng(width)
    q, _ = np.linalg.qr(rng.standard_normal((width, width)))
    for spectrum in (np.linspace(1, 2, width), np.append(np.full(2, 5.0), rng.random(width - 2)), np.append([3.0, 2.9999], np.zeros(width - 2))):
        a = (q * spectrum) @ q.T
        values, vectors = jacobi_davidson.leading_pairs(lambda b: a @ b, width, 4)
        assert np.allclose(values, np.sort(spectrum)[::-1][:4], atol=1e-12)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_minres_solves_a_shifted_system():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    a, shift = (q * np.arange(30.0)) @ q.T, np.array([4.3, -2.0])
    right = rng.standard_normal((30, 2))
    t = jacobi_davidson.minres(lambda b: a @ b, shift, lambda b: b, right, 40)
    assert np.allclose(a @ t - shift * t, right, atol=1e-8)


def brute_top(rows, scale=1024, every=100, top=10):
    own = usable(rows, scale)
    out = []
    for k, (i, q) in enumerate(own):
        if i is None or i % every:
            continue
        found = [(-sum(a * b for a, b in zip(q, x)), j is None, j or 0, j) for m, (j, x) in enumerate(own) if m != k]
        out += [(i, rank + 1, j, -score) for rank, (score, _, _, j) in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=str)


def top_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("every", [1, 7])
def test_search_against_all_pairs(spark, monkeypatch, every):
    monkeypatch.setattr(voronoi_knn, "QUERIES", 16)
    monkeypatch.setattr(voronoi_knn, "SLICE_ROWS", 100)
    monkeypatch.setattr(voronoi_knn, "PIVOTS", 20)
    rows = clustered(260) + ODD
    rng = random.Random(4)
    rows += [(1000 + rng.randrange(400), rows[5][1]) for _ in range(150)]
    got = voronoi_knn.top_by_inner_product(frame(spark, rows), every=every)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert top_rows(got) == brute_top(rows, every=every)


def test_bounds_keep_data_away_from_groups(spark, monkeypatch):
    """Clustered data: most groups are spared most rows, and nothing is lost."""
    monkeypatch.setattr(voronoi_knn, "QUERIES", 8)
    monkeypatch.setattr(voronoi_knn, "PIVOTS", 30)
    rows = clustered(600, clusters=10, seed=9)
    replicated = []
    streamed = voronoi_knn.streamed

    def counting(df, *rest):
        replicated.append((df.where("role = 1").count(), df.select("group").distinct().count()))
        return streamed(df, *rest)

    monkeypatch.setattr(voronoi_knn, "streamed", counting)
    assert top_rows(voronoi_knn.top_by_inner_product(frame(spark, rows), every=5)) == brute_top(rows, every=5)
    (copies, groups), = replicated
    assert groups > 10 and copies < 0.7 * groups * len(rows)


def test_search_of_small_and_empty_tables(spark):
    assert voronoi_knn.top_by_inner_product(frame(spark, [])).count() == 0
    assert voronoi_knn.top_by_inner_product(frame(spark, [(100, None)])).count() == 0
    assert voronoi_knn.top_by_inner_product(frame(spark, [(100, [1.0])])).count() == 0
    two = [(100, [1.0]), (101, [2.0])]
    assert top_rows(voronoi_knn.top_by_inner_product(frame(spark, two))) == brute_top(two)
    none = [(101, [1.0]), (102, [2.0])]
    assert top_rows(voronoi_knn.top_by_inner_product(frame(spark, none))) == []


def test_large_groups_of_cells_are_split_and_small_ones_joined():
    pivots = np.array([[0], [1], [10], [11]])
    places = voronoi_knn.grouped_cells({0: 25, 1: 3, 2: 4, 3: 5}, pivots, 10)
    assert places[0] == (0, 3) and places[2] == places[3] and places[1][1] == 1
    assert len({places[1][0], places[3][0], 0, 1, 2}) == 5


def test_inner_products_are_exact():
    x = np.array([[2**40, 3], [2**62, 2**62], [-5, 7]])
    got = inner_products(x, x)
    for i in range(3):
        for j in range(3):
            wide = sum(int(a) * int(b) for a, b in zip(x[i], x[j]))
            assert got[i, j] == max(-(2**63), min(2**63 - 1, wide))
