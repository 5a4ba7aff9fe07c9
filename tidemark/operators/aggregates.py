"""Grouped summaries of the flows; every one is a single hash aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.skew import balanced_join, group_anew, running_total


def total(col: str) -> Column:
    """Sum in which an all-missing group is 0."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def sum_per_key(df: DataFrame, key: Sequence[str], value: str, name: str) -> DataFrame:
    return group_anew(df.na.drop(subset=list(key)), key, total(value).alias(name))


def count_per_key(df: DataFrame, key: Sequence[str], counted: str, name: str) -> DataFrame:
    """Non-missing ``counted`` cells per key; rows with a missing key are left out."""
    return group_anew(df.na.drop(subset=list(key)), key, F.count(counted).alias(name))


def pivot_counts(df: DataFrame, rows: str, cols: str, values: Sequence[str], counted: str) -> DataFrame:
    """Counts of ``counted`` per row label and column label, absent cells 0."""
    table = df.na.drop(subset=[rows, cols]).groupBy(rows).pivot(cols, list(values))
    return table.agg(F.count(counted)).na.fill(0)


def pivot_means(df: DataFrame, rows: Sequence[str], cols: str, values: Sequence, measure: str) -> DataFrame:
    """Means of ``measure`` per row labels and column label, absent cells 0."""
    return df.groupBy(*rows).pivot(cols, list(values)).agg(F.avg(measure)).na.fill(0)


def sum_and_distinct(
    df: DataFrame, key: Sequence[str], value: str, counted: str, names: tuple[str, str]
) -> DataFrame:
    """Sum of ``value`` and number of different ``counted`` per key.

    Rows are first combined per key and counted value, so that a heavy key is spread
    over its values before it is gathered.
    """
    per_item = group_anew(df.na.drop(subset=list(key)), [*key, counted], total(value).alias("_sum"))
    return per_item.groupBy(*key).agg(
        F.sum("_sum").alias(names[0]), F.count(counted).alias(names[1])
    )


def flag_below_mean(df: DataFrame, value: str, by: Sequence[str], share: float = 0.9) -> DataFrame:
    """Append the group mean of ``value`` and ``Under`` for rows below ``share`` of it."""
    means = df.groupBy(*by).agg(F.avg(value).alias("group_mean"))
    flag = F.when(F.col(value) < F.col("group_mean") * share, "Under").otherwise("Normal")
    return balanced_join(df, means, by).withColumn("flag", flag)


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin (1 .. bins) between minimum and maximum; the top edge
    belongs to the last bin. Empty bins are absent."""
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e")).scalar()
    width = (edges["hi"] - edges["lo"]) / bins
    raw = F.floor((F.col(value) - edges["lo"]) / F.nullif(width, F.lit(0.0))) + 1
    bin_ = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins)).cast("int")
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def under_rate(entities: DataFrame, by: Sequence[str], status: str = "status") -> DataFrame:
    """Under-performers, entities, their share, and the mean ratio and absolute error."""
    under = F.count_if(F.col(status) == "Under")
    return entities.groupBy(*by).agg(
        under.alias("n_under"),
        F.count(F.lit(1)).alias("n_entities"),
        (under / F.count(F.lit(1))).alias("under_rate"),
        F.avg("perf_ratio").alias("mean_ratio"),
        F.avg("abs_error").alias("mean_abs_error"),
    )


def best_row(df: DataFrame, metric: str, largest: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the best metric; ties go to the smallest ``tie`` columns."""
    known = df.where(F.col(metric).isNotNull())
    order = F.col(metric).desc() if largest else F.col(metric).asc()
    return known.orderBy(order, *tie).limit(1)


def leading_dates(
    df: DataFrame, date: str, n: int, by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` distinct dates of each group, and the later ones."""
    days = df.where(F.col(date).isNotNull()).select(*by, date).distinct()
    placed = running_total(days, by, [date], name="_pos")
    return placed.where(F.col("_pos") < n).drop("_pos"), placed.where(F.col("_pos") >= n).drop("_pos")
