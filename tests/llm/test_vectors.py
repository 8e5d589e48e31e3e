import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import embedding_dedup as ed
from wakeline.llm import topk_search as tk
from wakeline.llm.queries import integer_vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def clusters(rng, groups, d=24):
    rows, k = [], 0
    for g in range(groups):
        base = rng.standard_normal(d)
        for _ in range(rng.integers(1, 9)):
            v = base + rng.uniform(0, 0.7) * rng.standard_normal(d)
            rows.append((k, [float(np.float32(x)) for x in v * rng.uniform(0.1, 5)], int(g % 4)))
            k += 1
    return rows


def linked(rows, threshold=0.93):
    n = len(rows)
    v = np.array([r[1] for r in rows])
    u = v / np.linalg.norm(v, axis=1)[:, None]
    hit = (u @ u.T >= threshold) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(hit, False)
    root = np.arange(n)
    while True:
        nxt = np.array([min([root[i], *root[hit[i]]]) for i in range(n)])
        if (nxt == root).all():
            break
        root = nxt
    return {rows[i][0]: (int(hit[i].sum()), rows[root[i]][0], root[i] == i) for i in range(n)}


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_dedup(spark, block):
    rows = clusters(np.random.default_rng(1), 50)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.embedding_dedup(spark.createDataFrame(rows, VECTORS), block_rows=block).collect()}
    assert got == linked(rows)


def test_bounds_hold_and_estimates_are_unbiased():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + rng.uniform(0, 0.2, (400, 1)) * rng.standard_normal((400, 64))
    y /= np.linalg.norm(y, axis=1)[:, None]
    code, factor = ed.codes(x)
    estimate, upper = ed.upper_bounds(code, factor, y)
    exact = x @ y.T
    assert (exact <= upper).all()
    assert abs((estimate - exact).mean()) < 0.01


def test_embedding_dedup_on_odd_tables(spark):
    one, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 2.0], 1), (7, [nan, 1.0, 2.0], 1), (8, [inf, 1.0, 2.0], 1), (9, [1.0, 2.0], 1), (None, one, 1), (10, one, 2), (11, [], 1), (12, [1e-38, 2e-38, 3e-38], 1), (13, [1e38, 2e38, 3e38], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS + ", block string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.embedding_dedup(df).collect()}
    assert got[1] == (3, 1, True) and got[2] == got[12] == got[13] == (3, 1, False)
    assert got[None] == (0, None, True)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert ed.embedding_dedup(df.limit(0)).count() == 0


def best(rows, k):
    ids = np.array([r[0] for r in rows])
    v = np.array([[math.floor(64 * x) for x in r[1]] for r in rows])
    out = []
    for i in np.flatnonzero(ids % 5 == 0):
        s = v @ v[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out += [(int(ids[i]), n, int(ids[j]), float(s[j])) for n, j in enumerate(order, 1)]
    return sorted(out)


@pytest.mark.parametrize(("blocks", "k"), [((1024, 8192), 7), ((8, 32), 7), ((8, 8), 1000)])
def test_topk(spark, blocks, k):
    rows = clusters(np.random.default_rng(3), 60)
    rows += [(len(rows) + i, r[1], 0) for i, r in enumerate(rows[:30])]  # ties
    df = spark.createDataFrame(rows, VECTORS).select("vec_id", F.expr("transform(embedding, x -> floor(64 * double(x)))").alias("v"))
    got = sorted(map(tuple, tk.topk_search(df, F.col("vec_id") % 5 == 0, k, query_rows=blocks[0], candidate_rows=blocks[1]).collect()))
    assert got == best(rows, k)


def test_statistics_bound_products():
    rng = np.random.default_rng(4)
    x, y = rng.standard_normal((50, 37)) + 0.3, rng.standard_normal((60, 37))
    exact = x @ y.T
    last = np.full(exact.shape, np.inf)
    for s in (1, 2, 4, 16, 37):
        upper = tk.statistics(x, s) @ tk.statistics(y, s).T
        assert (upper >= exact - 1e-9).all()
        last = upper
    assert last.shape == exact.shape


def test_whole_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.999, -0.001, -1e-20, 1e30]), (2, [nan, 1.0]), (3, [-inf, inf]), (4, [None]), (5, None)]
    got = {r.vec_id: r.v for r in integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got[1] == [63.0, -1.0, -1.0, 64 * float(np.float32(1e30))]
    assert got[2] == [None, 64.0] and got[3] == [None, None] and got[4] == [None] and got[5] is None


def test_topk_on_odd_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [2.0, 2.0]), (5, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, v array<double>, query int")
    got = sorted(map(tuple, tk.topk_search(df, F.col("vec_id") % 5 == 0, 3).collect()))
    assert got == [(0, 1, 4, 6.0), (0, 2, 6, 5.0)]
    assert tk.topk_search(df.limit(0), F.col("vec_id") % 5 == 0, 3).count() == 0
