"""Lookups and joins of the flows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.skew import balanced_join


def assert_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Pass ``df`` through; the query fails when a key occurs twice."""
    repeated = (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.max("_n"), F.lit(0)).alias("m"))
        .scalar()
    )
    text = F.lit(f"lookup key {', '.join(key)} is not unique")
    return df.where(F.when(repeated <= 1, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def lookup(
    fact: DataFrame, dim: DataFrame, key: str, value: str
) -> DataFrame:
    """Append ``value`` from a unique-key table; unmatched rows get a missing value."""
    if key not in fact.columns or key not in dim.columns:
        return fact
    unique = assert_unique(dim.select(key, value), [key])
    return balanced_join(fact, unique, [key], "left")


def common_key(fact: DataFrame, dim: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate name that both tables have."""
    return next((c for c in candidates if c in fact.columns and c in dim.columns), None)


def join_on_id(
    left: DataFrame,
    right: DataFrame,
    key: str,
    suffixes: tuple[str, str] = ("_cust", "_trans"),
) -> DataFrame:
    """Inner join of ``right`` facts to ``left`` on one key; other shared names get suffixes."""
    clash = (set(left.columns) & set(right.columns)) - {key}

    def tagged(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(c + suffix if c in clash else c) for c in df.columns])

    facts = tagged(right, suffixes[1])
    dims = tagged(left, suffixes[0])
    joined = balanced_join(facts, dims, [key])
    return joined.select(
        key,
        *[c for c in dims.columns if c != key],
        *[c for c in facts.columns if c != key],
    )


def join_weather(telemetry: DataFrame, weather: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Left join by plant and time only; the sensor's own key takes no part."""
    keys = ["plant", "date_time"]
    readings = weather.select(*keys, *measures)
    return balanced_join(telemetry, readings, keys, "left")


def fill_hours(hourly: DataFrame, by: Sequence[str], values: Sequence[str], groups: DataFrame) -> DataFrame:
    """All 24 hours for every row of ``groups``, absent hours filled with 0."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    spine = groups.select(*by, hours)
    return spine.join(hourly, [*by, "hour"], "left").na.fill(0, list(values))


def hour_spine(df: DataFrame, ts: str, by: Sequence[str]) -> DataFrame:
    """Every full hour between the first and last timestamp of each group."""
    first, last = (F.date_trunc("hour", f(ts)).cast("timestamp_ntz") for f in (F.min, F.max))
    spans = df.groupBy(*by).agg(first.alias("_a"), last.alias("_b"))
    # days first, then their 24 hours: a long span is never one array of hours
    day = F.explode(F.sequence(F.to_date("_a"), F.to_date("_b"), F.expr("INTERVAL 1 DAY"))).alias("_d")
    hour = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h")
    at = F.col("_d").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("_h"))
    hours = spans.select(*by, "_a", "_b", day).select(*by, "_a", "_b", "_d", hour)
    return hours.withColumn("hour_start", at).where("hour_start BETWEEN _a AND _b").select(*by, "hour_start")


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return balanced_join(df, keys.select(*on), on, "left_semi")


def stack_tables(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by column name; columns a table lacks are missing in its rows."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
