"""Joins and running totals that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.sizing import durable, fits_one_task


def balanced_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join of a large ``left`` with ``right`` (``how``: inner, left, left_semi).

    A plain join: when Spark re-plans it by the sizes of the shuffled partitions (adaptive
    execution, on by default), it splits partitions that a hot key makes large, of the left
    side for every ``how`` and of both sides for an inner join, and broadcasts a side that
    turned out small. No key is counted before and nothing is hinted from an estimate. With
    ``null_safe`` missing keys match each other.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    if not null_safe:
        return left.join(right, on, how)
    # a struct around a missing value is itself not missing, and equal to another such struct
    keys = [f"_k{i}" for i in range(len(on))]
    tagged = left.withColumns({k: F.struct(F.col(c).alias("v")) for k, c in zip(keys, on)})
    other = right.select(*[F.struct(F.col(c).alias("v")).alias(k) for k, c in zip(keys, on)],
                         *[c for c in right.columns if c not in on])
    return tagged.join(other, keys, how).drop(*keys)


def group_anew(df: DataFrame, by: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df.groupBy(*by).agg(*aggregates)`` for rows that come from a join on ``by``.

    Grouped by the columns themselves, the join's own partitions would do, and Spark then gives
    up splitting a hot key's, because that would cost one more exchange. Grouped by a struct of
    them there is an exchange in any case, of one row for each key and task that joins; so the
    join is split, and each part is aggregated where it was joined.
    """
    by = list(by)
    grouped = df.groupBy(F.struct(*by).alias("_key")).agg(*aggregates)
    return grouped.select("_key.*", *[c for c in grouped.columns if c != "_key"])


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    return reduce(
        lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    )


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
    name: str = "before",
) -> DataFrame:
    """Append the sum of ``weight`` (default: the number of rows) over all earlier rows
    of the same ``by`` group; ``by + order`` must identify a row.

    The rows are range-partitioned on the full key and stored, so a group of any size is
    spread over many slices: each is numbered on its own, and the totals of the slices
    before it (one row per group and slice) are added. A stored table of few rows, which is
    known by then, is numbered by a plain window instead, with the same result.
    """
    by, order = list(by), list(order)
    amount = F.col(weight) if weight else F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    sliced = durable(
        df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id())
    )
    if fits_one_task(sliced):
        plain = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return sliced.drop("_slice").withColumn(name, F.coalesce(F.sum(amount).over(plain), zero))
    earlier = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*by, "_slice")
        .agg(F.sum(amount).alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), zero))
        .drop("_sum")
    )
    inside = W.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = sliced.withColumn("_local", F.coalesce(F.sum(amount).over(inside), zero))
    joined = local.alias("l").join(offsets.alias("o"), _same("l", "o", [*by, "_slice"]), "left")
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._local") + F.col("o._offset")).alias(name),
    )
