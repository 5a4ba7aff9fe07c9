"""Sensor telemetry: join with weather, train on one plant, monitor every plant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import scalars as X
from tidemark.operators import aggregates as A, joins as J, learning as M, monitoring as Q
from tidemark.operators.sampling import fold_of, split_rows
from tidemark.sources.models import load_model, save_model

WEATHER_MEASURES = ("ambient_temperature", "module_temperature", "irradiation")
FEATURES = ("irradiation", "module_temperature", "ambient_temperature", "hour")
TARGET = "ac_power"
TRAIN_DAYS = 30
MODELS = ("Linear Regression", "Decision Tree", "Random Forest")


def with_date_parts(df: DataFrame, ts: str = "date_time") -> DataFrame:
    t = F.col(ts)
    return df.withColumns(
        {
            "date": F.to_date(t),
            "hour": F.hour(t),
            "minute": F.minute(t),
            "day": F.dayofmonth(t),
            "month": F.month(t),
            "time_slot": X.quarter_hour_slot(t),
        }
    )


def join_plants(generation: DataFrame, sensors: DataFrame) -> DataFrame:
    """Generation rows with the weather at the same plant and time (text timestamps)."""
    parse = {"date_time": X.parse_timestamp(F.col("date_time"))}
    return J.join_weather(
        generation.withColumns(parse), sensors.withColumns(parse), WEATHER_MEASURES
    )


def daytime(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Rows with light and all required measures."""
    lit = df.where(F.col("irradiation") > 0)
    return lit.na.drop(subset=list(required)) if required else lit


def entity_summary(day: DataFrame, by: Sequence[str] = ("plant", "source_key")) -> DataFrame:
    """Mean, maximum and total output per inverter, flagged below 90 % of the plant's mean."""
    summary = day.groupBy(*by).agg(
        F.avg("ac_power").alias("ac_mean"),
        F.max("ac_power").alias("ac_max"),
        F.coalesce(F.sum("ac_power"), F.lit(0.0)).alias("ac_total"),
        F.avg("dc_power").alias("dc_mean"),
        F.avg("daily_yield").alias("yield_mean"),
    )
    return A.flag_below_mean(summary, "ac_mean", [by[0]])


def training_rows(day: DataFrame, key: Sequence[str], plant: int = 1) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one plant, the train rows with a fold number."""
    train, test = split_rows(day.where(F.col("plant") == plant), key)
    return train.withColumn("fold", fold_of([F.col(k) for k in key])), test


def train_models(
    day: DataFrame,
    key: Sequence[str],
    root: str,
    plant: int = 1,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    names: Sequence[str] = MODELS,
) -> DataFrame:
    """Fit every model once on one plant and save it; returns the leaderboard of those models."""
    train, test = training_rows(day, key, plant)
    fitted: dict = {}
    board = M.regression_leaderboard(
        train, test, {name: M.REGRESSORS[name] for name in names}, features, target, whole=fitted
    )
    for name, model in fitted.items():
        save_model(model, root, name, target, f"plant{plant}")
    return board


def monitor(scored: DataFrame, by: Sequence[str] = ("plant", "source_key")) -> DataFrame:
    """Status per inverter from rows with ``actual`` and ``predicted``."""
    return Q.entity_status(Q.score_rows(scored), by)


def score_plants(day: DataFrame, root: str, name: str = "Random Forest", plant: int = 1) -> DataFrame:
    """Predictions of a saved model for the rows of every plant."""
    fitted = load_model(root, name, TARGET, f"plant{plant}")
    rows = day.na.drop(subset=[*FEATURES, TARGET])
    return M.predict(fitted, rows).withColumn("actual", F.col(TARGET))


def forecast_check(
    scored: DataFrame, train_days: int = TRAIN_DAYS, by: Sequence[str] = ("plant",)
) -> dict[str, DataFrame]:
    """Hourly, daily and hour-of-day errors on the dates after the first ``train_days``."""
    _, later = A.leading_dates(scored, "date", train_days, by)
    held_out = J.keep_matching(scored, later, [*by, "date"])
    hourly = Q.hourly_forecast(held_out, by)
    return {
        "hourly": hourly.withColumn("date_time", X.date_and_hour(F.col("date"), F.col("hour"))),
        "daily": Q.daily_forecast_error(hourly, by),
        "by_hour": Q.hourly_forecast_error(hourly, by),
    }
