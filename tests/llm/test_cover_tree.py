"""Dual cover-tree search against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aspectra.llm import cover_tree as C
from aspectra.llm import queries


def brute(rows, k, scale=256.0, every=50):
    """(query id, vector) -> [(score, id)], by Python integers."""
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((i, tuple(int(np.floor(scale * float(x))) for x in v)))
    out = {}
    for i, v in set(whole):
        if i % every == 0:
            got = [(sum(a * b for a, b in zip(v, w)), j) for j, w in set(whole) if j != i]
            if got:
                out.setdefault(i, []).append(sorted(got, key=lambda x: (-x[0], x[1]))[:k])
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    return {q: [(s, i) for _, s, i in sorted(rows)] for q, rows in out.items()}


def clustered(n, width, rnd, spread):
    centres = rnd.normal(size=(8, width))
    return centres[rnd.integers(0, 8, n)] + spread * rnd.normal(size=(n, width))


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_tree_invariants_and_search(spread):
    rnd = np.random.default_rng(3)
    x = np.floor(256 * clustered(3000, 6, rnd, spread))
    t = C.Tree(x)
    assert sorted(t.order.tolist()) == list(range(3000))
    for n in range(len(t.radii)):
        far = np.linalg.norm(t.points[t.lo[n]:t.hi[n]] - t.centres[n], axis=1)
        assert far.max() <= t.radii[n] + 1e-6
        if len(t.children[n]):
            assert [t.lo[c] for c in t.children[n]] + [t.hi[n]] == [t.lo[n]] + [t.hi[c] for c in t.children[n]]
        else:
            assert t.hi[n] - t.lo[n] <= C.LEAF or t.radii[n] == 0
    q = C.Tree(x[:400])
    best = C.Best(q.order, 5)
    calls = []
    plain = C.scores_of
    C.scores_of = lambda a, b, e: calls.append(len(a) * len(b)) or plain(a, b, e)
    try:
        C.search(q, t, t.order, best)
    finally:
        C.scores_of = plain
    s = (x[q.order] @ x.T).astype(np.int64)
    s[np.arange(400), q.order] = -(1 << 62)
    for i in range(400):
        by = np.lexsort((np.arange(3000), -s[i]))[:5]
        assert best.found[i].tolist() == by.tolist() and best.scores[i].tolist() == s[i][by].tolist()
    if spread < 0.1:
        assert sum(calls) < 400 * 3000 / 2          # the bounds do prune


def test_many_cells_blocks_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(C, "CELL_VALUES", 64 * 4)
    monkeypatch.setattr(C, "BLOCK", 6)
    monkeypatch.setattr(C, "SLICE", 3)
    rnd = np.random.default_rng(5)
    x = clustered(900, 4, rnd, 0.2)
    x[:300] = x[0]                                   # a third of all rows is one vector
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rnd.permutation(900), x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {q: v[0] for q, v in brute(rows, 5).items()}
    assert answers(C.top_k(df, F.col("vec_id") % 50 == 0)) == want


def test_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, 0.25]), (0, [0.5, 0.25]), (0, [-0.5, 0.25]), (50, [0.5]), (1, None), (2, [0.1, None]), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (None, [9.0, 9.0]), (5, []), (6, [0.5, 0.25]), (7, [0.5, 0.25]), (7, [0.5, 0.25]), (8, [-0.001, 0.0]),
            (100, []), (9, [1e-9, -1e-9])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "id long, `v.v` array<double>, q int, tree string")
    got = {}
    for r in C.top_k(df, F.col("id") % 50 == 0, 3, "id", "v.v").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = brute(rows, 3)
    assert got.keys() == want.keys() == {0, 50, 100}
    for q, lists in want.items():
        assert sorted(got[q]) == sorted((n, *a) for one in lists for n, a in enumerate(one, 1))


def test_empty_and_single(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert C.top_k(df, F.col("vec_id") % 50 == 0).count() == 0
    assert C.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    big = float(1 << 30)
    rows = [(0, [big + 1, big]), (1, [big, 1.0]), (2, [big + 1, 0.0]), (3, [-big, 3.0]), (4, [float(1 << 50)] * 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(C.top_k(df, F.col("vec_id") == 0, scale=1.0))[0]
    a = (1 << 30) + 1
    assert got == [((1 << 63) - 1, 4), (a * a, 2), (a * (1 << 30) + (1 << 30), 1), (-a * (1 << 30) + 3 * (1 << 30), 3)]


def test_query_against_brute_force(spark):
    at = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{at}/embeddings.parquet").collect()]
    assert answers(queries.op11_cover_tree_top_k(spark, at)) == {q: v[0] for q, v in brute(rows, 5).items()}
