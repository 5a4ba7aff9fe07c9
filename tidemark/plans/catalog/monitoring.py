"""Model quality metrics, performance monitoring, forecast checks."""

from pyspark.sql import functions as F

from tidemark.operators import learning as M, monitoring as Q
from tidemark.operators.sampling import fold_of
from tidemark.plans import bindings as B, telemetry as T
from tidemark.plans.catalog.base import query, r, rd, round_all
from tidemark.plans.catalog.grouping import FORECAST, FORECAST_DAYS, RATED, STATUS_SQL, mark_sql

#: A closed-form classifier, so that the metrics can be restated in SQL.
SCORED_DOCS_SQL = """scored_docs AS (
  SELECT doc_id, lang, quality AS label, CAST(CASE WHEN spaces / greatest(length, 1) > 0.12 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
    round(CAST(spaces / greatest(length, 1) AS DECIMAL(30,8)), 3) AS score FROM docs)"""
DOC_VIEWS = [B.DOCS_SQL, SCORED_DOCS_SQL]


def scored_docs(spark, sf):
    share = F.col("space_share")
    return B.doc_features(spark, sf).select(
        "doc_id",
        "lang",
        F.col("quality").alias("label"),
        F.when(share > 0.12, 1).otherwise(0).alias("prediction"),
        F.round(share.cast("decimal(30,8)"), 3).alias("score"),
    )


@query(
    "m17_reg_metrics",
    f"""SELECT plant, count(*) AS n, {r('avg(abs(actual - predicted))')} AS mae,
      {r('sqrt(avg((actual - predicted) * (actual - predicted)))')} AS rmse,
      {r('1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*))')} AS r2
      FROM scored GROUP BY 1""",
    RATED,
)
def m17_reg_metrics(spark, sf):
    return round_all(Q.regression_metrics(B.scored(spark, sf), ["plant"]))


@query(
    "m18_clf_metrics",
    f"""SELECT lang, {r('(tp + tn) / n')} AS accuracy, {r('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
      {r('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall, {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,
      {r('((tp + tn) / n - pe) / nullif(1 - pe, 0)')} AS kappa
      FROM (SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS pe FROM (
        SELECT lang, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
          CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM scored_docs GROUP BY 1))""",
    DOC_VIEWS,
)
def m18_clf_metrics(spark, sf):
    return round_all(Q.classification_metrics(scored_docs(spark, sf), ["lang"]))


@query(
    "m19_auc",
    f"""SELECT lang, {r('(sum(rk) FILTER (label = 1) - p * (p + 1) / 2) / nullif(p * q, 0)')} AS auc FROM (
      SELECT lang, label, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2 AS rk,
        CAST(count(*) FILTER (label = 1) OVER (PARTITION BY lang) AS DOUBLE) AS p,
        CAST(count(*) FILTER (label = 0) OVER (PARTITION BY lang) AS DOUBLE) AS q FROM scored_docs) GROUP BY lang, p, q""",
    DOC_VIEWS,
)
def m19_auc(spark, sf):
    return round_all(Q.roc_auc(scored_docs(spark, sf), ["lang"]))


@query(
    "m20_cv_ols",
    f"""SELECT 'line' AS model, {r('avg(r2)')} AS cv_r2, {r('avg(mae)')} AS cv_mae, {r('stddev_pop(mae)')} AS cv_mae_std FROM (
      SELECT fold, avg(abs(y - a - b * x)) AS mae, 1 - avg((y - a - b * x) * (y - a - b * x)) / var_pop(y) AS r2 FROM (
        SELECT v.fold, v.x, v.y, l.a, l.b FROM folded v JOIN (
          SELECT k.fold, regr_slope(f.y, f.x) AS b, regr_intercept(f.y, f.x) AS a
          FROM (SELECT DISTINCT fold FROM folded) k JOIN folded f ON f.fold <> k.fold GROUP BY 1) l ON l.fold = v.fold) GROUP BY 1)""",
    [
        B.TELEMETRY_SQL,
        f"""folded AS (SELECT irradiation AS x, ac_power AS y,
          CAST(('0x' || substr({mark_sql('event_id')}, 1, 7))::BIGINT % 5 AS INTEGER) AS fold FROM daytime)""",
    ],
)
def m20_cv_ols(spark, sf):
    """Five-fold cross-validation of a line, all folds from one pass."""
    rows = B.daytime(spark, sf).withColumn("fold", fold_of([F.col("event_id")]))
    scored = M.linear_folds(rows, "irradiation", "ac_power").withColumn("model", F.lit("line"))
    return round_all(M.cross_validated_regression(scored))


@query(
    "m22_monitor",
    f"""SELECT plant, source_key, {r('actual_mean')} AS actual_mean, {r('predicted_mean')} AS predicted_mean,
      {r('perf_ratio')} AS perf_ratio, {r('abs_error')} AS abs_error, {r('total_actual')} AS total_actual, status FROM entities""",
    [*RATED, STATUS_SQL],
)
def m22_monitor(spark, sf):
    return round_all(T.monitor(B.scored(spark, sf)))


FITTED_SQL = """line AS (SELECT regr_intercept(ac_power, irradiation) AS a, regr_slope(ac_power, irradiation) AS b
  FROM daytime WHERE plant = 1),
fitted AS (SELECT d.*, ac_power AS actual, a + b * irradiation AS predicted FROM daytime d, line)"""


@query(
    "m22_monitor_trained",
    f"""SELECT plant, source_key, {r('avg(actual)')} AS actual_mean, {r('avg(predicted)')} AS predicted_mean,
      {r('avg(least(greatest(actual / nullif(predicted, 0), 0), 2))')} AS perf_ratio,
      {r('avg(abs(actual - predicted))')} AS abs_error, {r('sum(actual)')} AS total_actual,
      CASE WHEN avg(least(greatest(actual / nullif(predicted, 0), 0), 2)) < 0.85 THEN 'Under' ELSE 'Normal' END AS status
      FROM fitted GROUP BY 1, 2""",
    [B.TELEMETRY_SQL, FITTED_SQL],
)
def m22_monitor_trained(spark, sf):
    """Train on plant 1, monitor the inverters of both plants."""
    day = B.daytime(spark, sf)
    fitted = M.fit(
        day.where(F.col("plant") == 1), M.REGRESSORS["Linear Regression"], ["irradiation"], "ac_power"
    )
    scored = M.predict(fitted, day).withColumn("actual", F.col("ac_power"))
    return round_all(T.monitor(scored))


@query(
    "m23_forecast",
    f"""SELECT h.plant, h.date, h.hour, {r('h.actual')} AS actual, {r('h.predicted')} AS predicted, {r('d.mape', 2)} AS mape
      FROM hourly h JOIN (SELECT plant, date, abs(sum(actual) - sum(predicted)) / nullif(sum(actual), 0) * 100 AS mape
        FROM hourly GROUP BY 1, 2) d ON h.plant = d.plant AND h.date = d.date""",
    FORECAST,
)
def m23_forecast(spark, sf):
    """Hourly actual and predicted on the held-out dates with each day's error."""
    check = T.forecast_check(B.scored(spark, sf), FORECAST_DAYS)
    daily = check["daily"].select("plant", "date", "mape")
    both = check["hourly"].join(daily, ["plant", "date"])
    return both.select(
        "plant", "date", "hour", rd("actual"), rd("predicted"), rd("mape", 2)
    )
