"""Predictive maintenance: targets, leaderboards, clusters, rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import scalars as X
from tidemark.functions.sizing import durable
from tidemark.operators import clustering as K, learning as M, mining as R
from tidemark.operators.sampling import stratified_folds, fold_of

# Columns left out of the supervised and unsupervised exports.
EXPORTS = {"full": (), "supervised": ("risk_score",), "unsupervised": ("risk_score", "RUL_days", "failure")}


def with_targets(readings: DataFrame) -> DataFrame:
    """Append maintenance count, risk score, failure flag and remaining days."""
    loudest = readings.agg(F.max("vibration_mms")).scalar()
    scored = readings.withColumn(
        "maintenance_count", X.service_count(F.col("operating_hours"))
    ).withColumn(
        "risk_score",
        X.risk_score(
            F.col("operating_hours"),
            F.col("vibration_mms"),
            loudest,
            F.col("temperature_C"),
            F.col("oil_temp_C"),
            F.col("days_since_maintenance"),
        ),
    )
    return scored.withColumns(
        {
            "RUL_days": X.remaining_days(F.col("risk_score")),
            "failure": X.failure_flag(X.failure_probability(F.col("risk_score"))),
        }
    )


def regression_board(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
    models: dict[str, M.Model] | None = None,
) -> DataFrame:
    folded = train.withColumn("fold", fold_of([F.col(k) for k in key]))
    return M.regression_leaderboard(folded, test, models or M.REGRESSORS, features, label)


def classification_board(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
    models: dict[str, M.Model] | None = None,
) -> DataFrame:
    folded = stratified_folds(train, label, key)
    return M.classification_leaderboard(folded, test, models or M.CLASSIFIERS, features, label)


def cluster_board(
    points: DataFrame, dims: int, key: str, eps: Sequence[float], min_points: int = 5
) -> DataFrame:
    """Quality of k-means, divisive and density clusterings, best silhouette first."""
    points = durable(points.select(key, "point"))
    runs = {f"K-Means (k={k})": K.kmeans(points, k) for k in (2, 3, 4)}
    runs |= {f"Bisecting (k={k})": K.bisecting(points, k) for k in (2, 3)}
    runs |= {f"Density (eps={e})": K.density_clusters(points, key, dims, e, min_points) for e in eps}
    rows = None
    for name, clustered in runs.items():
        row = K.cluster_quality(clustered, dims).select(F.lit(name).alias("model"), "*")
        rows = row if rows is None else rows.union(row)
    return rows.orderBy(F.desc_nulls_last("silhouette"), "model")


def rules(readings: DataFrame, sensors: Sequence[str], **limits: float) -> DataFrame:
    """Association rules between the terciles of sensors, highest lift first."""
    baskets = R.basket_counts(R.tercile_items(readings, sensors))
    found = R.association_rules(R.frequent_itemsets(baskets), **limits)
    return found.orderBy(F.desc("lift"), "antecedents", "consequents")
