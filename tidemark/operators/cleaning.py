"""Table clean-up: cropping, duplicates, missing values, encodings and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidemark.functions.scalars import known, rounded, to_number
from tidemark.operators.ordering import drop_leading, quantiles
from tidemark.operators.skew import balanced_join, running_total


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(*[known(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def markers_to_null(df: DataFrame, markers: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Replace text markers of a missing cell by NULL in the named text columns."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(list(markers)), F.col(c)) for c in cols if c in df.columns}
    )


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def crop(df: DataFrame, rows: int = 0, cols: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """Drop the first ``rows`` rows (in ``order``) and the first ``cols`` columns, trim names."""
    kept = drop_leading(df, rows, order) if rows else df
    return strip_names(kept.select(*[F.col(f"`{c}`") for c in df.columns[cols:]]))


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per ``key``: the first or last in ``order``, or (``none``) only unrepeated keys.

    Built as an aggregate, so copies are combined before the shuffle and a key with
    very many copies never gathers in one task. Missing keys count as equal.
    """
    key = list(key)
    row = F.struct(*df.columns)
    at = F.struct(*order)
    pick = {
        "first": F.min_by(row, at),
        "last": F.max_by(row, at),
        "none": F.max_by(row, at),
    }[keep]
    picked = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(
        pick.alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    if keep == "none":
        picked = picked.where(F.col("_n") == 1)
    return picked.select("_row.*")


def removed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, after and removed."""
    n_before = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return after.agg(F.count(F.lit(1)).alias("rows_after")).select(
        n_before.alias("rows_before"),
        "rows_after",
        (n_before - F.col("rows_after")).alias("rows_removed"),
    )


def fill_value(df: DataFrame, col: str, strategy: str | float) -> Column:
    """The imputation value as a one-row subquery: mean, median, mode or a constant."""
    if strategy == "mean":
        return df.agg(F.avg(col)).scalar()
    if strategy == "median":
        return quantiles(df, [col], {"median": 0.5}).select("median").scalar()
    if strategy == "mode":
        counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        return counts.agg(F.max_by(col, F.struct("_n", -F.col(col)))).scalar()
    return F.lit(float(strategy))


def impute(df: DataFrame, col: str, strategy: str | float = "mean") -> DataFrame:
    """Make ``col`` numeric and fill what is missing, the fill rounded to two decimals."""
    numeric = df.withColumn(col, to_number(F.col(col)))
    fill = rounded(fill_value(numeric, col, strategy), 2)
    return numeric.withColumn(col, F.coalesce(F.col(col), fill))


def fallback(df: DataFrame, col: str, other: str) -> DataFrame:
    """Fill missing cells of ``col`` from ``other`` where both columns exist."""
    if col in df.columns and other in df.columns:
        return df.withColumn(col, F.coalesce(col, other))
    return df


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing cells per column, one row per column, from a single pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in cols])
    return wide.select(F.inline(pairs))


def encode_fixed(col: str, labels: Sequence[str]) -> Column:
    """Position of a label in a given order; labels outside it are missing."""
    code = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(col)) - 1
    return F.when(code >= 0, code).cast("int")


def encode_sorted(df: DataFrame, col: str, name: str) -> DataFrame:
    """Position of each label among the sorted distinct labels."""
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = running_total(labels, [], [col], name=name).withColumn(name, F.col(name).cast("int"))
    return balanced_join(df, codes, [col], "left")


def scale_unit(df: DataFrame, cols: Sequence[str], epsilon: float = 1e-9) -> DataFrame:
    """Scale columns to [0, 1] by their minimum and maximum over the whole table."""
    bounds = df.agg(
        F.struct(
            *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]
        ).alias("b")
    ).scalar()
    return df.withColumns(
        {
            c: (F.col(c) - bounds[c]["lo"]) / (bounds[c]["hi"] - bounds[c]["lo"] + F.lit(epsilon))
            for c in cols
        }
    )
