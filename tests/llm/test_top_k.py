"""Exact top-k search against brute force and SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.llm.data import SF, clashing
from tidemark.llm import top_k

KIND = "vec_id long, vector array<bigint>"


def brute(vectors, queries, k):
    """vec_id and score of the k best of each query, by comparing all."""
    out = {}
    for q, a in queries:
        scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q and len(a) == len(b)]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def clustered(n, dims, spread, seed, top=60):
    draw = np.random.default_rng(seed)
    centres = draw.integers(-top, top + 1, (7, dims))
    return centres[draw.integers(0, 7, n)] + draw.integers(-spread, spread + 1, (n, dims))


@pytest.mark.parametrize("dims, spread, top", [(64, 2, 60), (5, 0, 2), (1, 3, 3), (20, 10, 1 << 20), (9, 1, 1 << 28)])
@pytest.mark.parametrize("few", [0.0, 0.1, 1.1])
def test_block_by_block(monkeypatch, dims, spread, top, few):
    monkeypatch.setattr(top_k, "FEW", few)
    monkeypatch.setattr(top_k, "RANKED", 100)
    points = clustered(400, dims, spread, dims, top)
    ids = np.random.default_rng(1).permutation(400)
    best = top_k.Best(ids[:50], points[:50], 6)
    for a in (0, 130, 390):
        stop = {0: 130, 130: 390, 390: 400}[a]
        order = a + np.argsort(ids[a:stop])
        best.meet(ids[order], points[order].T)
    want = brute([*zip(ids.tolist(), points.tolist())], [*zip(ids[:50].tolist(), points[:50].tolist())], 6)
    for row, q in enumerate(ids[:50].tolist()):
        assert [*zip(best.id[row].tolist(), best.score[row].tolist())] == want[q]


def test_bounds_save_work():
    points = clustered(4000, 64, 3, 3)
    best, work = top_k.Best(np.arange(100), points[:100], 10), 0
    for a in range(0, 4000, 500):
        work += best.meet(np.arange(a, a + 500), points[a : a + 500].T)
    assert work < 0.6 * 100 * 4000 * 64


def test_scores_must_fit():
    with pytest.raises(ValueError):
        top_k.Best(np.arange(1), np.array([[1 << 40]]), 1).meet(np.arange(1), np.array([[1 << 40]]))


def test_blocks_and_parts(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 40), ("QUERY_ROWS", 15), ("PART_BLOCKS", 2)):
        monkeypatch.setattr(top_k, name, value)
    points = clustered(300, 16, 1, 5, 3).tolist()
    rows = [(i * 7 % 300, v) for i, v in enumerate(points)] + [(1000 + i, points[0]) for i in range(60)] + [(5000, [1] * 3), (5001, [2] * 3), (5002, [])]
    df = clashing(spark.createDataFrame(rows, KIND))
    asked = df.where("vec_id % 10 = 0")
    got = found(top_k.top_k(df, asked, 8))
    assert got == {q: x for q, x in brute(rows, [r for r in rows if r[0] % 10 == 0], 8).items() if x}


def test_awkward_rows(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (2, [3, None]), (3, None), (None, [9, 9]), (4, [0, 0]), (5, [-1, -2]), (5, [2, 2])]
    df = clashing(spark.createDataFrame(rows, KIND))
    got = top_k.top_k(df, df, 3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows = {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()}
    assert {r for r in rows if r[0] == 1} == {(1, 1, 5, 6), (1, 2, 4, 0), (1, 3, 5, -5)}
    assert {r for r in rows if r[0] == 4} == {(4, 1, 1, 0), (4, 2, 5, 0), (4, 3, 5, 0)}
    assert top_k.top_k(df.limit(0), df, 3).count() == 0 and top_k.top_k(df, df.limit(0), 3).count() == 0


def test_finite(spark):
    rows = [([1.0],), ([None],), ([float("nan")],), ([float("-inf")],), (None,), ([],)]
    got = spark.createDataFrame(rows, "v array<float>").select(top_k.finite(F.col("v"))).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, True]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_query_matches_sql(spark, sf):
    name = "op12_exact_top_k"
    assert compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) is None
