"""Vantage-point search against brute force."""

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tests.llm.data import SF, clashing
from tidemark.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    """(query, rank, id, score) of every query, ties to the smaller id."""
    fine = {
        (i, tuple(v)) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    out = set()
    for q, a in fine:
        if q % every:
            continue
        found = []
        for i, b in fine:
            if i != q and len(a) == len(b):
                s = 0.0
                for x, y in zip(np.float32(a), np.float32(b)):
                    s += float(x) * float(y)
                found.append((-s, i))
        out |= {(q, r + 1, i, -s + 0.0) for r, (s, i) in enumerate(sorted(found)[:k])}
    return out


def found(df, **options):
    rows = neighbours.neighbours(df, df.where("vec_id % 20 = 0"), **options).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_matches_sql(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        assert compare(entry.queries()["op6_neighbours"](spark, sf), connect(sf), entry.oracle_sql()["op6_neighbours"]) is None


@pytest.mark.parametrize("shard", [40, 100_000])
def test_ties_copies_and_lengths(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    monkeypatch.setattr(neighbours, "LEAF", 8)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 3)
    draw = np.random.default_rng(4)
    common = draw.normal(size=8).round(2).tolist()
    rows = [(i, common if i % 3 == 0 else (draw.integers(-2, 3, 8) * draw.choice([1, 5])).astype(float).tolist(), 0) for i in range(300)]
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [1.0, None] + [0.0] * 6, 0), (320, [float("nan")] + [1.0] * 7, 0),
             (340, [float("inf")] * 8, 0), (None, common, 0), (360, [1.0, 2.0, 3.0], 0), (361, [3.0, 1.0, 1.0], 0), (20, rows[20][1], 5)]
    df = clashing(spark.createDataFrame(rows, SCHEMA).drop("score", "rank"))
    assert found(df) == brute([r[:2] for r in rows])


def test_many_distinct_vectors_tie(spark):
    # pairs of 40 components: most score 0 or 1, far more than k tie, the smallest ids lie anywhere
    ids = np.random.default_rng(6).permutation(780)
    pairs = [(a, b) for a in range(40) for b in range(a)]
    rows = [(int(i), [float(d in pair) for d in range(40)], 0) for i, pair in zip(ids, pairs)]
    rows += [(21, rows[5][1], 0), (41, rows[6][1], 0), rows[7]]  # an id with two vectors, a repeated row
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute([r[:2] for r in rows])


def test_relaxed_search_has_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    exact = {(q, i) for q, _, i, _ in found(df)}
    for factor, least in ((0.8, 0.95), (0.5, 0.9)):
        relaxed = {(q, i) for q, _, i, _ in found(df, factor=factor)}
        assert len(relaxed & exact) >= least * len(exact)


def test_empty_and_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (7, [0.5, 0.5], 1)], SCHEMA)
    assert found(df) == {(0, 1, 7, 0.5)}
    assert found(df.limit(0)) == set() and found(df.where("vec_id = 0")) == set()
