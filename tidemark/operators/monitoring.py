"""Scoring of predictions: row errors, entity status, quality metrics, forecast checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import performance_ratio, percentage_error, status
from tidemark.operators.skew import running_total


def score_rows(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Append error, absolute error and bounded performance ratio."""
    a, p = F.col(actual), F.col(predicted)
    return df.withColumns(
        {"error": a - p, "abs_error": F.abs(a - p), "perf_ratio": performance_ratio(a, p)}
    )


def entity_status(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean actual, prediction, ratio and absolute error per entity, with its status.

    The ratio is the mean of the row ratios, not the ratio of the means.
    """
    return (
        scored.groupBy(*by)
        .agg(
            F.avg("actual").alias("actual_mean"),
            F.avg("predicted").alias("predicted_mean"),
            F.avg("perf_ratio").alias("perf_ratio"),
            F.avg("abs_error").alias("abs_error"),
            F.coalesce(F.sum("actual"), F.lit(0.0)).alias("total_actual"),
        )
        .withColumn("status", status(F.col("perf_ratio")))
    )


def daily_performance(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.coalesce(F.sum("actual"), F.lit(0.0)).alias("actual_sum"),
        F.coalesce(F.sum("predicted"), F.lit(0.0)).alias("predicted_sum"),
        F.avg("perf_ratio").alias("perf_ratio"),
    )


def hourly_forecast(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean actual and predicted per date and hour."""
    return scored.groupBy(*by, "date", "hour").agg(
        F.avg("actual").alias("actual"), F.avg("predicted").alias("predicted")
    )


def daily_forecast_error(hourly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hourly means summed per day, with the percentage error of the sums."""
    daily = hourly.groupBy(*by, "date").agg(
        F.coalesce(F.sum("actual"), F.lit(0.0)).alias("actual"),
        F.coalesce(F.sum("predicted"), F.lit(0.0)).alias("predicted"),
    )
    return daily.withColumn("mape", percentage_error(F.col("actual"), F.col("predicted")))


def hourly_forecast_error(hourly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean error per hour of day."""
    return hourly.groupBy(*by, "hour").agg(
        F.avg(F.col("actual") - F.col("predicted")).alias("mean_error")
    )


def regression_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error, root mean squared error and R² in one pass."""
    e = F.col("actual") - F.col("predicted")
    sums = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("_mse"),
        F.var_pop("actual").alias("_var"),
    )
    return sums.select(
        *by,
        "n",
        "mae",
        F.sqrt("_mse").alias("rmse"),
        (1 - F.col("_mse") / F.nullif(F.col("_var"), F.lit(0.0))).alias("r2"),
    )


def classification_metrics(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", predicted: str = "prediction"
) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 (0 when undefined) and Cohen's kappa."""
    y, p = F.col(label), F.col(predicted)
    counts = scored.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).cast("double").alias("tp"),
        F.count_if((y == 0) & (p == 1)).cast("double").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("double").alias("fn"),
        F.count_if((y == 0) & (p == 0)).cast("double").alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    zero = F.lit(0.0)
    accuracy = (tp + tn) / F.nullif(n, zero)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / F.nullif(n * n, zero)
    return counts.select(
        *by,
        accuracy.alias("accuracy"),
        F.coalesce(tp / F.nullif(tp + fp, zero), zero).alias("precision"),
        F.coalesce(tp / F.nullif(tp + fn, zero), zero).alias("recall"),
        F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, zero), zero).alias("f1"),
        ((accuracy - chance) / F.nullif(1 - chance, zero)).alias("kappa"),
    )


def roc_auc(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """Area under the ROC curve from rank sums; tied scores share their mean rank.

    Works on the counts per distinct score, so ties cost one row and no rank is joined
    back to the scored rows.
    """
    by = list(by)
    counts = scored.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count(F.lit(1)).alias("_n")
    )
    below = running_total(counts, by, [score], "_n", "_below")
    rank = F.col("_below") + (F.col("_n") + 1) / F.lit(2.0)
    sums = below.groupBy(*by).agg(
        F.sum(F.col("_pos") * rank).alias("_ranks"),
        F.sum("_pos").cast("double").alias("_p"),
        F.sum(F.col("_n") - F.col("_pos")).cast("double").alias("_q"),
    )
    p, q = F.col("_p"), F.col("_q")
    return sums.select(
        *by, ((F.col("_ranks") - p * (p + 1) / 2) / F.nullif(p * q, F.lit(0.0))).alias("auc")
    )


