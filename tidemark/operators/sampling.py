"""Reproducible samples, splits and folds keyed on the rows' own identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import hash_order
from tidemark.operators.skew import balanced_join, running_total


#: Hex digits of a hash that a long holds.
HASH_DIGITS = 15


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows, the same ones on every run and cluster."""
    mark = hash_order([F.col(k) for k in key], seed)
    return df.orderBy(mark, *key).limit(n)


def sample_per_group(
    df: DataFrame, n: int, key: Sequence[str], by: Sequence[str], seed: int = 42
) -> DataFrame:
    """``n`` pseudo-random rows of each group.

    Each group's smallest hashes bound the sample: counting rows by hash prefix first
    finds how much of the hash range holds ``n`` rows, so that only little more than
    the sample itself is ordered, whatever the group's size. The prefix grows with the
    largest group: a cell holds about ``n`` of its rows.
    """
    by = list(by)
    marked = df.withColumn("_mark", hash_order([F.col(k) for k in key], seed))
    most = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 1
    digits = max(1, min(HASH_DIGITS, len(f"{most // max(1, n):x}")))
    cells = marked.groupBy(*by, F.substring("_mark", 1, digits).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    before = running_total(cells, by, ["_cell"], "_n", "_below")
    limit = before.where(F.col("_below") < n).groupBy(*by).agg(F.max("_cell").alias("_last"))
    joined = balanced_join(marked, limit, by, null_safe=True)
    near = joined.where(F.substring("_mark", 1, digits) <= F.col("_last"))
    placed = running_total(near.drop("_last"), by, ["_mark", *key], name="_pos")
    return placed.where(F.col("_pos") < n).drop("_pos", "_mark")


def is_test_row(key: Sequence[Column], share: float = 0.2) -> Column:
    """True for about ``share`` (between 0 and 1) of all rows, decided by the key's hash: its
    first 15 hex digits, read as a number, are below that share of their range."""
    if not 0 < share < 1:
        raise ValueError(f"share must be between 0 and 1: {share}")
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key]))
    number = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")
    return number < F.lit(int(share * 16**HASH_DIGITS))


def split_rows(df: DataFrame, key: Sequence[str], share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; every row is in exactly one of them on every evaluation."""
    test = is_test_row([F.col(k) for k in key], share)
    return df.where(~test), df.where(test)


def fold_of(key: Sequence[Column], folds: int = 5, seed: int = 42) -> Column:
    """Fold number 0 .. folds-1 from the key's hash."""
    digits = F.substring(hash_order(key, seed), 1, 7)
    return (F.conv(digits, 16, 10).cast("long") % folds).cast("int")


def stratified_folds(
    df: DataFrame, label: str, key: Sequence[str], folds: int = 5, seed: int = 42
) -> DataFrame:
    """Append ``fold`` so that every label is spread evenly over the folds."""
    marked = df.withColumn("_mark", hash_order([F.col(k) for k in key], seed))
    placed = running_total(marked, [label], ["_mark", *key], name="_pos")
    return placed.withColumn("fold", (F.col("_pos") % folds).cast("int")).drop("_pos", "_mark")
