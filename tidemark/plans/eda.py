"""Exploratory analysis: the data frame behind every chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators import sampling as L, statistics as S

SAMPLE_SIZE = 3000
# The pairs of the trend charts.
TREND_PAIRS = (
    ("irradiation", "ac_power"),
    ("module_temperature", "ac_power"),
    ("ambient_temperature", "ac_power"),
    ("module_temperature", "irradiation"),
    ("time_slot", "ac_power"),
    ("ambient_temperature", "module_temperature"),
    ("irradiation", "daily_yield"),
    ("time_slot", "irradiation"),
    ("ambient_temperature", "daily_yield"),
)


def correlations(day: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Stronger of the linear and the rank correlation for every pair of columns."""
    rows = day.na.drop(subset=list(cols)).select(*by, *cols)
    return S.best_correlation(
        S.pearson(rows, cols, by), S.spearman(rows, cols, by, complete=True), by
    )


def pair_report(
    day: DataFrame,
    pairs: Sequence[tuple[str, str]],
    key: Sequence[str],
    by: Sequence[str] = (),
    parts: Sequence[str] = ("points", "trends", "curves", "limits"),
) -> dict[str, DataFrame]:
    """Sampled points, trend on the sample, its curve, and axis limits over all rows; only the
    ``parts`` asked for are planned, and the sample is drawn only for those that need it."""
    cols = sorted({c for pair in pairs for c in pair})
    rows = day.select(*by, *key, *cols)
    out = {}
    if "limits" in parts:
        out["limits"] = S.axis_limits(rows, cols, by)
    if {"points", "trends", "curves"} & set(parts):
        sample = (
            L.sample_per_group(rows, SAMPLE_SIZE, key, by) if by else L.sample_rows(rows, SAMPLE_SIZE, key)
        )
        out["points"] = S.point_pairs(sample, pairs, [*by, *key])
        out["trends"] = S.best_degree(sample, pairs, by)
        out["curves"] = S.degree_curve(out["trends"], 300, by)
    return {part: out[part] for part in parts}
