"""Whitening of integer vectors by principal components to double precision.

Sums and products of the distinct vectors are summed exactly, in integers, by Spark; the products
are of vectors centred at the rounded mean. Only d sums and d (d + 1) / 2 products of dimensions
reach the driver. There, eigenvectors in float32 are the start; iterations of matrix products in
extended precision (Ogita and Aishima) correct all of them at once, and each about doubles the
number of right digits. Eigenvectors whose values are too close to be told apart by the present
error are corrected as a group: the iteration makes them orthonormal, and a small eigenproblem in
the space they span, shifted by their mean value, turns them into place.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored

#: Extended precision of the iterations, and the most of them (each squares the error).
WIDE, ROUNDS = np.longdouble, 30


class Whitening(NamedTuple):
    """Number of distinct vectors, exact sums, the covariance's trace, and its eigenpairs by
    falling value (columns are unit vectors); values that are zero but for rounding are 0."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray


def _groups(values: np.ndarray, gap) -> list[np.ndarray]:
    """Numbers of values in groups whose neighbours lie within ``gap``; single ones are left out."""
    order = np.argsort(values, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1)
    return [p for p in parts if len(p) > 1]


def refine(matrix: np.ndarray, vectors: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric ``matrix`` in its precision, from approximate
    ``vectors`` (columns)."""
    a, x = matrix, vectors.astype(matrix.dtype)
    unit = np.eye(len(a), dtype=a.dtype)
    enough = 8 * len(a) * np.finfo(a.dtype).eps
    size = np.sqrt(np.square(a).sum())
    for _ in range(rounds):
        r = unit - x.T @ x
        s = x.T @ (a @ x)
        values = s.diagonal() / (1 - r.diagonal())
        wrong = s - np.diag(values)
        if np.abs(r).max() <= enough and np.abs(wrong).max() <= enough * size:
            break
        near = 2 * (np.sqrt(np.square(wrong).sum()) + size * np.sqrt(np.square(r).sum()))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > near
        # with separate values the error of a pair follows from R and S, else only R is known
        error = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ error
        for group in _groups(values, near):
            part = x[:, group]
            middle = values[group].mean()
            small = part.T @ (a @ part - middle * part)
            spread = np.abs(small).max()
            if np.abs(small - np.diag(small.diagonal())).max() > enough * size:
                _, turn = np.linalg.eigh(((small + small.T) / (2 * spread)).astype(np.float64))
                x[:, group] = part @ turn.astype(a.dtype)
    return values, x


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors (columns) of a symmetric matrix."""
    scale = np.abs(matrix).max(initial=0)
    if not scale:
        return np.zeros(len(matrix), matrix.dtype), np.eye(len(matrix), dtype=matrix.dtype)
    _, start = np.linalg.eigh((matrix / scale).astype(np.float32))
    values, vectors = refine(matrix / scale, start)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    vectors = vectors / np.sqrt(np.square(vectors).sum(0))
    # either sign is right; this one is the same on every run
    top = vectors[np.abs(vectors).argmax(0), np.arange(len(matrix))]
    return values[order] * scale, vectors * np.where(top < 0, -1, 1)


def _wide(number: int):
    """An integer in extended precision."""
    high = float(number)
    return WIDE(high) + WIDE(float(number - int(high)))


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            column = batch.column("vector")
            yield column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summed(fit_list: DataFrame, dim: int, centre: list[int] | None = None) -> dict[tuple[int, int], int]:
    """Exact sums of the dimensions (i, i), or of the products of pairs (i, j) of dimensions of
    the vectors less ``centre``. A sum is taken in a task, then over the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim) if centre else dim, object)  # of Python's integers
        for x in _matrices(batches, dim):
            for a in range(0, len(x), 4096):
                total += _products(x[a : a + 4096], centre)
        i, j = np.triu_indices(dim) if centre else (np.arange(dim),) * 2
        cells = pa.array([str(v) for v in (total[i, j] if centre else total)], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), cells], ["i", "j", "s"])

    sums = fit_list.mapInArrow(add, "i long, j long, s string").groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in sums.collect()}  # d sums, or d (d + 1) / 2


def _products(x: np.ndarray, centre: list[int] | None) -> np.ndarray:
    """Sums over a few rows, or products of their dimensions once centred: in floats or longs
    where these are exact."""
    most = float(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, centre or [0]))
    if most * len(x) >= 2**62:
        x = x.astype(object)
    if centre is None:
        return x.sum(0).astype(object)
    z = x - np.array(centre, x.dtype)
    bound = most**2 * len(x)
    z = z.astype(float) if bound < 2**53 else z if bound < 2**62 else z.astype(object)
    found = z.T @ z
    return (found.astype(np.int64) if found.dtype == float else found).astype(object)


def fit(fit_list: DataFrame, dim: int) -> Whitening | None:
    """The whitening of the rows of ``fit_list`` (vector), all of length ``dim`` above 0; None
    without rows."""
    n = fit_list.count()
    if not n:
        return None
    found = _summed(fit_list, dim)
    sums = [found[i, i] for i in range(dim)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = _summed(fit_list, dim, centre)
    left = [s - n * c for s, c in zip(sums, centre)]
    square = _wide(n * n)
    matrix = np.empty((dim, dim), WIDE)
    for (i, j), p in products.items():
        matrix[i, j] = matrix[j, i] = _wide(n * p - left[i] * left[j]) / square
    values, vectors = eigenpairs(matrix)
    trace = matrix.trace()
    values[values <= 8 * dim * np.finfo(WIDE).eps * trace] = 0
    return Whitening(n, sums, float(trace), values.astype(float), vectors.astype(float))


def transform(vectors: DataFrame, model: Whitening, components: int) -> DataFrame:
    """``vectors`` (vector, of the model's length) with ``deviation``, the sum over dimensions of
    (n x - S)^2, null where it does not fit a long, and ``whitened``, an array with a value for
    each of the first ``components`` components, null for those without spread."""
    dim, names = len(model.sums), [c for c in vectors.columns if c not in ("vector", "deviation", "whitened")]
    spread = model.values[:components]
    scaled = model.vectors[:, :components] / np.sqrt(np.where(spread > 0, spread, 1))
    flat = spread <= 0
    limit = 2.0**62 / model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            x = np.concatenate([np.zeros((0, dim), np.int64), *_matrices([batch], dim)])
            small = np.abs(x).max(initial=0) < limit and max(map(abs, model.sums)) < 2**62
            moved = x * model.n - sums.astype(np.int64) if small else x.astype(object) * model.n - sums
            values = (moved / model.n).astype(float) @ scaled
            about = np.square(moved.astype(float)).sum(1)
            fits = about < 2.0**63 * (1 - 1e-9)
            exact = np.square(np.where(fits[:, None], moved, 0)).sum(1).astype(np.int64)
            mask = np.broadcast_to(flat, values.shape).ravel()
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(flat)), pa.array(values.ravel(), pa.float64(), mask=mask)
            )
            deviation = pa.array(exact, pa.int64(), mask=~fits)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), deviation, lists], [*names, "deviation", "whitened"])

    kept = "".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}, " for c in names)
    return vectors.select(*names, "vector").mapInArrow(run, f"{kept}deviation long, whitened array<double>")


def identity_error(fit_list: DataFrame, model: Whitening, components: int) -> float | None:
    """The largest entry of the covariance of the whitened rows of ``fit_list``, less the
    identity, over the components with spread; None if none has."""
    used = int((model.values[:components] > 0).sum())
    if not used:
        return None
    values = [F.get("whitened", F.lit(i)) for i in range(used)]
    pairs = [(i, j) for i in range(used) for j in range(i + 1)]
    means = [F.avg(v).alias(f"m{i}") for i, v in enumerate(values)]
    products = [F.avg(values[i] * values[j]).alias(f"p{i}_{j}") for i, j in pairs]
    row = transform(fit_list, model, used).agg(*means, *products).first()
    return max(abs(row[f"p{i}_{j}"] - row[f"m{i}"] * row[f"m{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """Principal components of ``vectors`` (vec_id, vector: an array of longs), whitened.

    Returns for each row and each of the first ``components`` components (all, if vectors have
    fewer dimensions): vec_id, component from 1, n, deviation, whitened, explained,
    identity_error. Sums and covariance are over the ``n`` distinct vectors, so copies of a
    vector weigh nothing; every row gets values, repeated rows and null ids too. Null vectors,
    empty ones and such with a null take no part; of several lengths the one of most rows (ties:
    the longest) is used and the others take no part. A component without spread has no
    ``whitened`` value and explains 0; if all vectors are equal ``explained`` and
    ``identity_error`` are null. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.where("size(vector) > 0 AND forall(vector, x -> x IS NOT NULL)").select(
        F.col("vec_id").cast("long"), F.col("vector").cast("array<bigint>")
    )
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 0
    rows = rows.where(F.size("vector") == dim)
    fit_list = stored(rows.select("vector").distinct())
    model = fit(fit_list, dim) if dim else None
    if model is None:
        return spark.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    error = identity_error(fit_list, model, components)
    shares = [float(v) / model.trace if model.trace else None for v in model.values[:components]]
    numbered = transform(rows, model, components).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(x).cast("double") for x in shares])
    return numbered.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
