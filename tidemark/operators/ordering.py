"""Positions, ranks and exact quantiles that do not depend on any group fitting in a task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sizing import durable
from tidemark.operators.skew import balanced_join, group_anew, running_total

#: Accuracy of the sketch of a group's values (ranks are wrong by one in so many at most), the
#: share of ranks to either side of a quantile that it brackets, and the size of a group that is
#: taken whole: the share of a larger one is several rows.
ACCURACY, BRACKET, FEW_VALUES = 10_000, 0.002, 5_000


def every_kth(
    df: DataFrame, k: int, order: Sequence[str], by: Sequence[str] = (), start: int = 0
) -> DataFrame:
    """Rows ``start``, ``start + k``, ... (0-based) of each time-ordered group."""
    placed = running_total(df, by, order, name="_pos")
    return placed.where((F.col("_pos") >= start) & ((F.col("_pos") - start) % k == 0)).drop("_pos")


def drop_leading(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Remove the first ``n`` rows in ``order``, which must identify a row."""
    if n == 0:
        return df
    key = F.struct(*order)
    last = df.select(key.alias("k")).orderBy("k").limit(n).agg(F.max("k")).scalar()
    return df.where(key > last)


def value_counts(df: DataFrame, cols: Sequence[str], name: str = "count") -> DataFrame:
    """Number of rows per value; unordered, so that callers sort only at the sink."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def first_seen(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """Distinct values with the earliest ``order`` at which each occurs (``first_at``)."""
    return df.groupBy(*cols).agg(F.min(order).alias("first_at"))


def top_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Append the 1-based rank of ``value`` within ``by``; ties share their mean rank.

    Rows with a missing value are left out; rows with a missing group key are a group. Ranks are
    computed on the distinct values and joined back, so repeated values cost one row each.
    """
    by = list(by)
    known = df.where(F.col(value).isNotNull())
    ranks = distinct_ranks(known, value, by, name)
    return balanced_join(known, ranks, [*by, value], "left", null_safe=True)


def distinct_ranks(df: DataFrame, value: str, by: Sequence[str], name: str = "rank") -> DataFrame:
    """One row per group and distinct value with its mean rank."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    below = running_total(counts, by, [value], "_n", "_below")
    return below.select(
        *by, value, (F.col("_below") + (F.col("_n") + 1) / F.lit(2.0)).alias(name)
    )


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (``by``, ``column``).

    ``probs`` maps output names to probabilities in [0, 1]; missing values and, as in
    any grouped summary here, missing group keys are ignored.

    A sketch brackets every requested position between two values, with room to spare. It is
    stored, so that its true size is known and few groups are sent to the rows: dealt out by a few
    groups, the rows would fill as few tasks. Then one pass counts the values between brackets and
    keeps only those inside, of which the two order statistics around the position are read off
    after a distributed running total. So what is put in order is a small share of the rows,
    whatever their number.
    """
    by, cols = list(by), list(cols)
    present = df.na.drop(subset=by) if by else df
    names = list(probs)
    long = present.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in cols
                ]
            )
        ).alias("_s"),
    ).select(*by, "_s.column", "_s.value").where(F.col("value").isNotNull())
    group = [*by, "column"]
    around = [min(max(p + side, 0.0), 1.0) for p in probs.values() for side in (-BRACKET, BRACKET)]
    sketch = durable(
        long.groupBy(*group).agg(F.count(F.lit(1)).alias("_total"), F.percentile_approx("value", around, ACCURACY).alias("_q"))
    )
    bounds = [(F.col("_q")[2 * i], F.col("_q")[2 * i + 1]) for i in range(len(names))]
    value = F.col("value")
    inside = reduce(lambda a, b: a | b, [(value >= low) & (value <= high) for low, high in bounds])
    inside = inside | (F.col("_total") <= FEW_VALUES)
    # a value between brackets counts where the next one begins, before that one's own values
    ahead = F.array_min(F.array(*[F.when(low > value, low) for low, _ in bounds]))
    at = F.when(inside, value).otherwise(F.coalesce(ahead, F.lit(float("inf"))))
    cells = balanced_join(long, sketch, group).select(*group, "_total", at.alias("_at"), inside.cast("int").alias("_in"))
    counts = group_anew(cells, [*group, "_total", "_at", "_in"], F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, group, ["_at", "_in"], "_n", "_below")
    # Position p sits at row p * (total - 1); `holds` finds the value occupying a row.

    def holds(row: Column) -> Column:
        here = (F.col("_below") <= row) & (row < F.col("_below") + F.col("_n")) & (F.col("_in") == 1)
        missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
        return F.coalesce(F.max(F.when(here, F.col("_at"))), missed)

    total = F.col("_total")
    at = {n: F.lit(float(p)) * (total - 1) for n, p in probs.items()}
    ends = placed.groupBy(*group, "_total").agg(
        *[holds(F.floor(at[n])).alias(f"_lo_{n}") for n in names],
        *[holds(F.ceil(at[n])).alias(f"_hi_{n}") for n in names],
    )
    return ends.select(
        *group,
        *[
            (
                F.col(f"_lo_{n}")
                + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (at[n] - F.floor(at[n]))
            ).alias(n)
            for n in names
        ],
    )


def box_summary(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, the furthest values within 1.5 interquartile ranges, and the row count."""
    by = list(by)
    box = quantiles(df, [value], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).drop("column")
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    known = df.where(F.col(value).isNotNull()).select(*by, value)
    fenced = balanced_join(known, box, by)
    inside = (F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)
    found = group_anew(
        fenced,
        [*by, "q1", "median", "q3"],
        F.min(F.when(inside, F.col(value))).alias("_low"),
        F.max(F.when(inside, F.col(value))).alias("_high"),
        F.count(F.lit(1)).alias("n"),
    )
    return found.select(
        *by, "q1", "median", "q3", F.least("q1", "_low").alias("whisker_low"), F.greatest("q3", "_high").alias("whisker_high"), "n"
    )
