"""Top-k search against brute force, whitening against plain linear algebra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import top_k, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, key string, x string, query string, score string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "k", "x", "q", "s", "n") for i, v in rows], SCHEMA)


def plain_top(rows, k=10):
    """By brute force: every row but the query's own, by score and id."""
    good = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    usual = max(lengths, key=lambda n: (lengths.count(n), n), default=0)
    good = [(i, v) for i, v in good if len(v) == usual]
    out = []
    for at, (i, v) in enumerate(good):
        if i is None or i % 100:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j) for other, (j, w) in enumerate(good) if other != at]
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(i, rank, s[2], -s[0]) for rank, s in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def searched(spark, rows, k=10):
    found = top_k.search(frame(spark, rows), F.col("vec_id") % 100 == 0, k)
    return sorted((tuple(r) for r in found.collect()), key=str)


def random_rows(seed, n, dims, copies=0, grid=None):
    draw = np.random.default_rng(seed)
    values = draw.standard_normal((n, dims)).astype(np.float32)
    if grid:
        values = np.round(values * grid) / grid  # ties
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(values)]
    hot = rows[n // 2][1]
    return rows + [(n + i, hot) for i in range(copies)]


@pytest.mark.parametrize("seed,n,dims,copies,grid", [(1, 900, 7, 0, None), (2, 700, 3, 500, 2), (3, 400, 64, 30, 1), (4, 1500, 2, 0, 1)])
def test_search_against_brute_force(spark, seed, n, dims, copies, grid):
    rows = random_rows(seed, n, dims, copies, grid)
    assert searched(spark, rows) == plain_top(rows)


def test_bounds_rule_out_no_winner():
    for seed in range(30):
        draw = np.random.default_rng(seed)
        dims = int(draw.integers(1, 20))
        held = draw.integers(-50, 50, (int(draw.integers(50, 2500)), dims)) ** (1 + 2 * (seed % 2))
        ranks = draw.permutation(len(held))
        lists = top_k.Lists(held, ranks)
        for query in draw.integers(-9, 9, (12, dims)):
            scores = held @ query
            want = np.lexsort((ranks, -scores))[:11]
            places, got = lists.best(query, 11)
            assert places.tolist() == want.tolist() and got.tolist() == scores[want].tolist()


def test_skewed_lists_are_not_read_to_the_end():
    draw = np.random.default_rng(9)
    held = (draw.pareto(1.5, (20_000, 4)) * 100).astype(np.int64)
    lists = top_k.Lists(held, np.arange(len(held)))
    reads = []
    places = lists.places
    lists.places = type("Counted", (), {"__getitem__": lambda self, s: reads.append(s) or places[s]})()
    assert len(lists.insiders(np.array([3, 1, 2, 1]), 11)) <= 44
    assert max(s[1].stop for s in reads) < 20_000 // 4


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (100, [0.0, 0.0]), (200, None), (300, []), (400, [1.0, None]), (500, [NAN, 1.0]), (600, [INF, 1.0]), (700, [-INF, 1.0]),
        (800, [1.0]), (900, [1.0, 2.0, 3.0]), (1, [1.0, 2.0]), (0, [1.0, 2.0]), (2, [-1.5, 0.25]), (None, [1.0, 2.0]), (None, [9.0, 9.0]), (-100, [0.0, 5.0]),
        (1000, [1.0, 2.0]), (3, [1e-6, -1e-6]),
    ]
    assert searched(spark, rows) == plain_top(rows)
    assert searched(spark, rows, 2) == plain_top(rows, 2)
    assert searched(spark, []) == [] and searched(spark, [(1, [1.0])]) == [] and searched(spark, [(100, [1.0])]) == []
    assert searched(spark, [(i * 100, [1.0, 1.0]) for i in range(25)]) == plain_top([(i * 100, [1.0, 1.0]) for i in range(25)])
    big = [(i, [40_000.0 if i == 5 else float(i)]) for i in range(8)]
    assert searched(spark, big) == plain_top([r for r in big if r[0] != 5])


# ---------------------------------------------------------------- whitening


def plain_numbers(rows):
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    usual = max(lengths, key=lambda n: (lengths.count(n), n), default=0)
    return [(i, v) for i, v in good if len(v) == usual]


def check_whitening(spark, rows, k=16):
    vectors = frame(spark, rows)
    model = whitening.fit_whitening(vectors, k)
    got = whitening.whitened_entries(whitening.whiten(vectors, model), model).collect()
    numbers = plain_numbers(rows)
    fit = sorted({tuple(v) for _, v in numbers})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array(fit, dtype=np.float64) - np.array(sums) / n
    spread = centred.T @ centred / n
    values, parts = np.linalg.eigh(spread)
    values, parts = values[::-1], parts[:, ::-1]
    assert len(got) == len(numbers) * min(k, d)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert np.allclose(model.eigenvalues, np.maximum(values, 0), rtol=1e-9, atol=1e-9 * values[0])
    for i, v in numbers:
        for r in by_row[i][1]:
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(v, sums))
    assert np.allclose([g.explained for g in got], [values[g.component - 1] / spread.trace() for g in got], rtol=1e-4, atol=1e-12)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    # one sign for all rows, and each component an eigenvector
    residual = spread @ model.components - model.components * model.eigenvalues[: min(k, d)]
    assert np.abs(residual).max() <= 1e-12 * values[0] * d
    assert np.abs(model.components.T @ model.components - np.eye(min(k, d))).max() < 1e-14
    unique = {i: v for i, v in numbers if sum(i == j for j, _ in numbers) == 1}
    for i, v in list(unique.items())[:50]:
        want = (np.array(v) - np.array(sums) / n) @ model.components / np.sqrt(model.eigenvalues[: min(k, d)])
        assert np.allclose([by_row[i][c + 1][0].whitened for c in range(min(k, d))], want, rtol=1e-9, atol=1e-9)
    return model


@pytest.mark.parametrize("seed,n,dims,copies", [(1, 500, 5, 0), (2, 800, 24, 400), (3, 2000, 64, 10)])
def test_whitening_against_plain(spark, seed, n, dims, copies):
    check_whitening(spark, random_rows(seed, n, dims, copies))


def test_components_agree_with_plain_ones(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.standard_normal((3000, 8)) * np.array([9, 7, 5, 4, 3, 2, 1.5, 1]))]
    model = check_whitening(spark, rows, 8)
    values = np.array([v for _, v in plain_numbers(rows)], dtype=np.longdouble)
    want = np.linalg.eigh(np.cov(values.T.astype(np.float64), bias=True))[1][:, ::-1]
    assert np.allclose(np.abs(np.sum(want * model.components, axis=0)), 1, atol=1e-14)
    assert np.abs(np.abs(want) - np.abs(model.components)).max() < 1e-12


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0].astype(np.longdouble)
    q = q @ (1.5 * np.eye(len(values)) - 0.5 * q.T @ q)  # orthonormal in extended precision
    a = q @ np.diag(np.array(values, dtype=np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        [9, 8, 7, 1], [5, 5, 5, 5], [3, 3, 2, 2, 1, 1, 0, 0], [1 + 1e-9, 1, 1 - 1e-9, 0.5], [1, 1 - 1e-7, 1 - 2e-7, 0.9, 0.9 - 1e-10, 1e-3, 1e-6, 0],
        [100, *[1 + 1e-8 * i for i in range(30)], *[0.5 + 1e-11 * i for i in range(10)]], [0, 0, 0], [7], [1e6, 1, 1e-6, 1e-12],
    ],
)
def test_refinement(values):
    values = sorted(values, reverse=True)
    a, q = spectrum(values)
    got, x = whitening.eigen(a)
    scale = max(values[0], 1e-300)
    assert np.abs(got - np.array(values)).max() <= 4e-16 * scale * len(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15 * len(values)
    assert np.abs(a @ x - x * got).max() <= 1e-15 * scale * len(values)
    for i, v in enumerate(values):  # eigenvectors of values apart by 1e-10 or more are those that made the matrix
        if min([abs(v - w) for j, w in enumerate(values) if j != i], default=1) >= 1e-11 * scale:
            assert 1 - abs(float(q[:, i] @ x[:, i])) < 1e-13, (i, v)
            assert np.abs(np.abs(q[:, i]) - np.abs(x[:, i])).max() < 1e-8


def test_odd_whitening(spark):
    rows = [
        (1, [1.0, 2.0, 0.5]), (2, [0.0, 0.0, 0.5]), (3, None), (4, []), (5, [1.0, None, 1.0]), (6, [NAN, 1.0, 1.0]), (7, [INF, 1.0, 1.0]),
        (8, [1.0]), (9, [1.0, 2.0, 0.5]), (1, [3.0, -2.0, 0.5]), (None, [5.0, 1.0, 0.5]), (10, [1e30, 0.0, 0.0]),
    ]
    vectors = frame(spark, rows)
    model = whitening.fit_whitening(vectors)
    got = whitening.whitened_entries(whitening.whiten(vectors, model), model).collect()
    assert model.n == 4 and len(got) == 5 * 3
    assert all((r.whitened is None) == (r.component == 3) for r in got)  # the third dimension is constant
    assert got[0].identity_error < 1e-9
    same = frame(spark, [(1, [1.0, 1.0]), (2, [1.0, 1.0])])
    model = whitening.fit_whitening(same)
    got = whitening.whitened_entries(whitening.whiten(same, model), model).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(0, None, None, None)] * 4
    none = frame(spark, [(1, None)])
    assert whitening.fit_whitening(none) is None
    assert whitening.whitened_entries(whitening.whiten(none, None), None).count() == 0
    large = frame(spark, [(i, [float(2**33) * (i % 7), float(i)]) for i in range(40)])
    model = whitening.fit_whitening(large)
    assert whitening.whiten(large, model).where("deviation is null").count() > 0 and model.identity_error < 1e-6
