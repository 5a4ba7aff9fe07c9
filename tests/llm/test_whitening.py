"""Whitening against exact covariances and known eigenvectors."""

from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm.data import SF, clashing
from tidemark.llm import whitening

KIND = "vec_id long, vector array<bigint>"
WIDE = whitening.WIDE


def orthogonal(n, seed):
    """An orthogonal matrix in extended precision."""
    x = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(WIDE)
    for _ in range(4):
        x = x @ (3 * np.eye(n, dtype=WIDE) - x.T @ x) / 2
    return x


def exact(points):
    """Distinct points, sums and covariance in fractions."""
    rows = sorted(set(map(tuple, points)))
    n, d = len(rows), len(rows[0])
    sums = [sum(r[i] for r in rows) for i in range(d)]
    centred = [[Fraction(r[i]) - Fraction(sums[i], n) for i in range(d)] for r in rows]
    return rows, sums, [[sum(c[i] * c[j] for c in centred) / n for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("seed, n", [(0, 3), (1, 20), (2, 64)])
def test_refined_to_full_precision(seed, n):
    q = orthogonal(n, seed)
    values = np.sort(np.random.default_rng(seed).uniform(0.1, 9, n).astype(WIDE))[::-1]
    got, x = whitening.eigenpairs(q * values @ q.T)
    assert np.abs(got - values).max() < 1e-17 * n
    assert np.abs(np.abs((x * q).sum(0)) - 1).max() < 1e-17 * n and np.abs(x - q * np.sign((x * q).sum(0))).max() < 1e-15


@pytest.mark.parametrize("gap", [1e-5, 1e-8, 1e-11])
def test_clustered_values_are_solved_apart(gap):
    n = 24
    q = orthogonal(n, 5)
    values = np.concatenate([[4, 3], 2 + WIDE(gap) * np.arange(6, 0, -1), 1 + WIDE(gap) * np.arange(5, 0, -1), np.linspace(0.9, 0.1, 11)]).astype(WIDE)
    matrix = q * values @ q.T
    got, x = whitening.eigenpairs(matrix)
    own = np.abs(x - q * np.sign((x * q).sum(0))).max()
    double = np.linalg.eigh(matrix.astype(float))[1][:, ::-1]
    assert np.abs(got - values).max() < 1e-17 * n and own < 1e-17 / gap
    assert own < 0.1 * np.abs(double - q.astype(float) * np.sign((double * q.astype(float)).sum(0))).max()


def test_equal_values_and_zero_matrix():
    q = orthogonal(8, 9)
    values = np.array([5, 3, 3, 3, 1, 1, 0, 0], WIDE)
    got, x = whitening.eigenpairs(q * values @ q.T)
    assert np.abs(got - values).max() < 1e-16 and np.abs(x.T @ x - np.eye(8)).max() < 1e-16
    assert np.abs((q * values @ q.T) @ x - x * got).max() < 1e-16
    got, x = whitening.eigenpairs(np.zeros((3, 3), WIDE))
    assert (got == 0).all() and (x == np.eye(3)).all()


def check(points, df, components):
    rows, sums, covariance = exact(points)
    n, d = len(rows), len(sums)
    got = {(r.vec_id, r.component): r for r in df.collect()}
    k = min(components, d)
    assert len(got) == len(points) * k == df.count()
    trace = float(sum(covariance[i][i] for i in range(d)))
    v = np.array([[float(x) for x in row] for row in covariance])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    for j in range(k):
        column = np.array([got[i, j + 1].whitened for i in range(len(points))], float)
        centred = np.array([[float(Fraction(p[i]) - Fraction(sums[i], n)) for i in range(d)] for p in points])
        want = centred @ vectors[:, j] / np.sqrt(values[j])
        sign = np.sign(want @ column)
        assert np.abs(column - sign * want).max() < 1e-9 * np.abs(want).max()
        for i, p in enumerate(points):
            r = got[i, j + 1]
            deviation = sum((n * p[m] - sums[m]) ** 2 for m in range(d))
            assert r.n == n and r.deviation == (deviation if deviation < 2**63 else None)
            assert abs(r.explained - values[j] / trace) < 1e-9 and r.identity_error < 1e-9


@pytest.mark.parametrize("top, dims", [(9, 3), (300, 12), (1 << 27, 2)])
def test_whitened_rows(spark, top, dims):
    draw = np.random.default_rng(top)
    points = draw.integers(-top, top, (80, dims)) * np.arange(1, dims + 1) + top
    points[40:60] = points[3]
    points = points.tolist()
    df = clashing(spark.createDataFrame([(i, p) for i, p in enumerate(points)], KIND)).repartition(5)
    check(points, whitening.whiten(df), 4)


def test_query_on_its_table(spark):
    import pyarrow.parquet as pq

    found = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    assert [r["vec_id"] for r in found] == list(range(len(found)))
    points = [[int(np.floor(256 * float(x))) for x in r["embedding"]] for r in found]
    check(points, entry.queries()["op13_whitening"](spark, SF), 4)


def test_awkward_rows(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (None, [3, 2]), (2, [5, 2]), (3, None), (4, [1, None]), (5, []), (6, [1, 2, 3])]
    df = clashing(spark.createDataFrame(rows, KIND))
    got = whitening.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1"] * 4 + ["2"] * 2 + ["None"] * 2
    for r in got:
        assert r.n == 3 and (r.whitened is None) == (r.component == 2) and r.explained == (1.0 if r.component == 1 else 0.0)
        assert r.identity_error < 1e-12
    same = whitening.whiten(df.where("vec_id = 1")).collect()
    assert len(same) == 4 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(0, None, None, None)}
    assert whitening.whiten(df.limit(0)).count() == 0
    wide = [(i, [1 << 58, i << 57]) for i in range(3)]
    huge = whitening.whiten(spark.createDataFrame(wide, KIND)).where("component = 1").orderBy("vec_id").collect()
    assert [r.deviation for r in huge] == [None, 0, None] and abs(abs(huge[0].whitened) - 1.5**0.5) < 1e-12
