"""Model training queries. Results of iterative fits have no SQL twin; linear ones do."""

from pyspark.ml import Pipeline, classification as C, regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.sizing import durable
from tidemark.operators import learning as M
from tidemark.operators.monitoring import classification_metrics
from tidemark.operators.sampling import split_rows
from tidemark.plans import bindings as B, maintenance as W, telemetry as T
from tidemark.plans.catalog.base import query, r, rd, round_all
from tidemark.plans.catalog.cleaning import RISK_SQL

DAY = [B.TELEMETRY_SQL]


def asset_split(spark, sf):
    """Stored once: splits and folds read it several times."""
    columns = ["l_partkey", *B.FEATURES, "RUL_days", "failure"]
    return split_rows(durable(B.labelled_assets(spark, sf).select(*columns)), ["l_partkey"])


def doc_split(spark, sf):
    """Stored once, so that splits and folds do not go over the texts again."""
    columns = ["doc_id", *B.DOC_FEATURES, "quality"]
    return split_rows(durable(B.doc_features(spark, sf).select(*columns)), ["doc_id"])


@query(
    "m1_scale",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      {r('(load_pct - (SELECT avg(load_pct) FROM machines)) / (SELECT stddev_pop(load_pct) FROM machines)')} AS load_scaled,
      {r('(temperature_C - (SELECT avg(temperature_C) FROM machines)) / (SELECT stddev_pop(temperature_C) FROM machines)')} AS temperature_scaled
      FROM machines""",
    [B.MACHINES_SQL],
)
def m1_scale(spark, sf):
    rows = B.machines(spark, sf)
    names = ["load_pct", "temperature_C"]
    stages = [VectorAssembler(inputCols=names, outputCol="assembled")]
    stages += M.scaling_stages(rows.count(), 2, "assembled", "scaled")
    scaled = Pipeline(stages=stages).fit(rows).transform(rows)
    values = vector_to_array("scaled")
    return scaled.select(
        *B.MACHINE_KEY, rd(values[0]).alias("load_scaled"), rd(values[1]).alias("temperature_scaled")
    )


@query(
    "m3_linear",
    f"""SELECT event_id, {r('my + b1 * (irradiation - m1) + b2 * (ambient_temperature - m2)')} AS predicted
      FROM daytime, (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2
        FROM (SELECT avg(ac_power) AS my, avg(irradiation) AS m1, avg(ambient_temperature) AS m2,
          var_pop(irradiation) AS v1, var_pop(ambient_temperature) AS v2, covar_pop(irradiation, ambient_temperature) AS c12,
          covar_pop(irradiation, ac_power) AS c1y, covar_pop(ambient_temperature, ac_power) AS c2y FROM daytime WHERE plant = 1)) f""",
    DAY,
)
def m3_linear(spark, sf):
    """Two-feature least squares trained on plant 1; the SQL solves the normal equations."""
    return _plant_model(spark, sf, "Linear Regression", ["irradiation", "ambient_temperature"])


@query(
    "m4_ridge",
    f"""SELECT event_id, {r('my + (n * c / s) / (n + 1) * ((irradiation - m) / s)')} AS predicted
      FROM daytime, (SELECT count(*) AS n, avg(ac_power) AS my, avg(irradiation) AS m, stddev_pop(irradiation) AS s,
        covar_pop(irradiation, ac_power) AS c FROM daytime WHERE plant = 1) f""",
    DAY,
)
def m4_ridge(spark, sf):
    """Ridge with penalty 1 on the standardised feature; the SQL is its closed form."""
    return _plant_model(spark, sf, "Ridge Regression", ["irradiation"])


def _plant_model(spark, sf, name, features):
    day = B.daytime(spark, sf)
    fitted = M.fit(day.where(F.col("plant") == 1), M.REGRESSORS[name], features, T.TARGET)
    return M.predict(fitted, day).select("event_id", rd("predicted"))


def _regressor(name):
    def run(spark, sf):
        train, test = map(durable, asset_split(spark, sf))
        fitted = M.fit(train, M.REGRESSORS[name], B.FEATURES, "RUL_days")
        rows = train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))
        return M.predict(fitted, rows).select("l_partkey", "held_out", "RUL_days", "predicted")

    run.__doc__ = f"{name} of the remaining days per part: predictions of all parts (M14)."
    return run


for _key, _name in [("m5_tree", "Decision Tree"), ("m6_forest", "Random Forest"), ("m7_boosting", "Gradient Boosting")]:
    query(_key)(_regressor(_name))


def _classifier(name):
    def run(spark, sf):
        rows = durable(B.all_doc_features(spark, sf).select("doc_id", *B.DOC_FEATURES, "quality"))
        train, _ = split_rows(rows.where("quality IS NOT NULL"), ["doc_id"])
        fitted = M.fit(train, M.CLASSIFIERS[name], B.DOC_FEATURES, "quality")
        return M.classify(fitted, rows).select("doc_id", "quality", "prediction", "score")

    run.__doc__ = f"{name} of document quality: predictions and scores of all documents (M14, M15)."
    return run


for _key, _name in [
    ("m8_tree_classifier", "Decision Tree"),
    ("m9_logistic", "Logistic Regression"),
    ("m10_svc", "Linear SVC"),
    ("m11_forest_classifier", "Random Forest"),
    ("m12_boosting_classifier", "Gradient Boosting"),
    ("m13_network", "MLP Neural Network"),
]:
    query(_key)(_classifier(_name))


@query("m16_importance")
def m16_importance(spark, sf):
    """Feature importances of a forest on the telemetry of plant 1."""
    train, _ = T.training_rows(B.daytime(spark, sf), ["event_id"])
    fitted = M.fit(train, M.REGRESSORS["Random Forest"], T.FEATURES, T.TARGET)
    return M.importances(fitted, train)


@query("m21_power_leaderboard")
def m21_power_leaderboard(spark, sf):
    """Power models of plant 1: held-out and cross-validated metrics."""
    train, test = T.training_rows(B.daytime(spark, sf), ["event_id"])
    models = {name: M.REGRESSORS[name] for name in T.MODELS}
    return round_all(M.regression_leaderboard(train, test, models, T.FEATURES, T.TARGET))


@query("m21_life_leaderboard")
def m21_life_leaderboard(spark, sf):
    """All regressors of the remaining days per part."""
    train, test = asset_split(spark, sf)
    return round_all(W.regression_board(train, test, B.FEATURES, "RUL_days", ["l_partkey"]))


@query("m21_quality_leaderboard")
def m21_quality_leaderboard(spark, sf):
    """All classifiers of document quality."""
    train, test = doc_split(spark, sf)
    return round_all(W.classification_board(train, test, B.DOC_FEATURES, "quality", ["doc_id"]))


# --- models small enough for SQL to state: one split, one round, one feature -----------


def _stump_sql(rows: str, x: str, y: str) -> str:
    """The split of ``x`` that leaves the least variance in ``y``, and the means beside it."""
    return f"""sums AS (SELECT CAST({x} AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n, CAST(sum({y}) AS DOUBLE) AS s FROM {rows} GROUP BY 1),
    cuts AS (SELECT c.x AS cut, sum(CASE WHEN o.x <= c.x THEN o.n END) AS ln, sum(CASE WHEN o.x <= c.x THEN o.s END) AS ls,
      sum(CASE WHEN o.x > c.x THEN o.n END) AS rn, sum(CASE WHEN o.x > c.x THEN o.s END) AS rs FROM sums c JOIN sums o ON true GROUP BY 1),
    stump AS (SELECT cut, ls / ln AS low, rs / rn AS high FROM cuts WHERE rn > 0 ORDER BY ls * ls / ln + rs * rs / rn DESC, cut LIMIT 1)"""


#: One depth, bins enough for every value of the feature.
_ONE_SPLIT = {"featuresCol": "features", "labelCol": "label", "maxDepth": 1, "maxBins": 400, "seed": M.SEED}
HOUR_SELECT = f"SELECT event_id, {r('CASE WHEN hour <= cut THEN low ELSE high END')} AS predicted FROM daytime, stump"
HOUR_VIEWS = [B.TELEMETRY_SQL, _stump_sql("daytime", "hour", "ac_power")]


def _hour_model(spark, sf, build):
    day = B.daytime(spark, sf)
    fitted = M.fit(day, M.Model(lambda f: build()), ["hour"], "ac_power")
    return M.predict(fitted, day).select("event_id", rd("predicted"))


@query("m5_one_split", HOUR_SELECT, HOUR_VIEWS)
def m5_one_split(spark, sf):
    """Regression tree of one split on the hour."""
    return _hour_model(spark, sf, lambda: R.DecisionTreeRegressor(**_ONE_SPLIT))


@query("m6_one_tree", HOUR_SELECT, HOUR_VIEWS)
def m6_one_tree(spark, sf):
    """Forest of one tree of one split that sees every row."""
    return _hour_model(spark, sf, lambda: R.RandomForestRegressor(**_ONE_SPLIT, numTrees=1, featureSubsetStrategy="all", bootstrap=False))


@query("m7_one_round", HOUR_SELECT, HOUR_VIEWS)
def m7_one_round(spark, sf):
    """Boosting of one round: the first tree has weight 1."""
    return _hour_model(spark, sf, lambda: R.GBTRegressor(**_ONE_SPLIT, maxIter=1))


#: Machine failure by the risk in hundredths. For two classes, the split of least impurity is the
#: one of least variance of the 0/1 label.
FAILURE_SQL = """failing AS (SELECT *, floor(100 * round(risk_score, 6)) AS risk_band, CASE WHEN 1 / (1 + exp(-10 * (risk_score - 0.65))) >= 0.5 THEN 1 ELSE 0 END AS failure FROM risk)"""
BAND, DAYS = "risk_band", "days_since_maintenance"
FAILURE_VIEWS = [B.MACHINES_SQL, RISK_SQL, FAILURE_SQL, _stump_sql("failing", BAND, "failure")]
SIDE = f"CASE WHEN {BAND} <= cut THEN low ELSE high END"
KEY = ", ".join(B.MACHINE_KEY)
FAILURE_SELECT = f"""SELECT {KEY}, CAST({SIDE} > 0.5 AS INTEGER) AS prediction, {r(SIDE)} AS score FROM failing, stump"""


def _failure_model(spark, sf, build):
    band = F.floor(100 * F.round("risk_score", 6)).cast("double").alias(BAND)
    rows = B.labelled_machines(spark, sf).select(*B.MACHINE_KEY, band, "failure")
    fitted = M.fit(rows, M.Model(lambda f: build()), [BAND], "failure")
    return M.classify(fitted, rows).select(*B.MACHINE_KEY, F.col("prediction").cast("int"), rd("score"))


@query("m8_failure_split", FAILURE_SELECT, FAILURE_VIEWS)
def m8_failure_split(spark, sf):
    """Failure of every machine reading by a tree of one split (M15: its positive score)."""
    return _failure_model(spark, sf, lambda: C.DecisionTreeClassifier(**_ONE_SPLIT))


@query("m11_failure_tree", FAILURE_SELECT, FAILURE_VIEWS)
def m11_failure_tree(spark, sf):
    return _failure_model(
        spark, sf, lambda: C.RandomForestClassifier(**_ONE_SPLIT, numTrees=1, featureSubsetStrategy="all", bootstrap=False)
    )


@query(
    "m12_failure_round",
    f"""SELECT {KEY}, CAST({SIDE} > 0.5 AS INTEGER) AS prediction, {r(f'1 / (1 + exp(-2 * (2 * ({SIDE}) - 1)))')} AS score FROM failing, stump""",
    FAILURE_VIEWS,
)
def m12_failure_round(spark, sf):
    """Boosting of one round: a regression tree of the label as -1 and 1, its score by the logistic function."""
    return _failure_model(spark, sf, lambda: C.GBTClassifier(**_ONE_SPLIT, maxIter=1))


@query(
    "m9_failure_optimum",
    "SELECT count(*) AS n, CAST(0 AS DOUBLE) AS slope_intercept, CAST(0 AS DOUBLE) AS slope_weight FROM machines",
    [B.MACHINES_SQL],
)
def m9_failure_optimum(spark, sf):
    """Logistic model of failure: at its optimum the loss has no slope in the intercept and in
    the weight of the standardised feature."""
    rows = durable(B.labelled_machines(spark, sf).select("risk_score", "failure"))
    fitted = M.fit(rows, M.CLASSIFIERS["Logistic Regression"], ["risk_score"], "failure")
    z = vector_to_array("features")[0]
    error = vector_to_array("probability")[1] - F.col("failure")
    weight, n = fitted.stages[-1].coefficients[0], rows.count()
    sums = fitted.transform(rows).agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("a"), F.avg(error * z).alias("b"))
    return sums.select("n", rd(F.col("a"), 3).alias("slope_intercept"), rd(F.col("b") + weight / n, 3).alias("slope_weight"))


@query("m16_one_feature", "SELECT 'hour' AS feature, CAST(1 AS DOUBLE) AS importance")
def m16_one_feature(spark, sf):
    """All importance falls to the only feature."""
    day = B.daytime(spark, sf)
    fitted = M.fit(day, M.Model(lambda f: R.DecisionTreeRegressor(**_ONE_SPLIT)), ["hour"], "ac_power")
    return round_all(M.importances(fitted, day))


#: A closed-form classifier of failure whose metrics SQL can restate.
GUESS_SQL = """guessed AS (SELECT failure, risk_score, CASE WHEN days_since_maintenance > 180 THEN 1 ELSE 0 END AS prediction FROM failing)"""


@query(
    "m18_failure_metrics",
    f"""SELECT {r('(tp + tn) / n')} AS accuracy, {r('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
      {r('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall, {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,
      {r('((tp + tn) / n - pe) / nullif(1 - pe, 0)')} AS kappa
      FROM (SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS pe FROM (
        SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (failure = 1 AND prediction = 1) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (failure = 0 AND prediction = 1) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (failure = 1 AND prediction = 0) AS DOUBLE) AS fn,
          CAST(count(*) FILTER (failure = 0 AND prediction = 0) AS DOUBLE) AS tn FROM guessed))""",
    [B.MACHINES_SQL, RISK_SQL, FAILURE_SQL, GUESS_SQL],
)
def m18_failure_metrics(spark, sf):
    rows = B.labelled_machines(spark, sf).select(
        F.col("failure").alias("label"), F.when(F.col(DAYS) > 180, 1).otherwise(0).alias("prediction")
    )
    return round_all(classification_metrics(rows))


@query("m21_failure_leaderboard")
def m21_failure_leaderboard(spark, sf):
    """All classifiers of machine failure per part, on the machine features."""
    train, test = asset_split(spark, sf)
    return round_all(W.classification_board(train, test, B.FEATURES, "failure", ["l_partkey"]))


DC_FEATURES = ("irradiation", "module_temperature", "ambient_temperature", "hour", "time_slot", "ac_power", "daily_yield")


@query(
    "m3_dc_power",
    f"""SELECT event_id, {r('my + c / v * (ac_power - m)')} AS predicted FROM daytime,
      (SELECT avg(dc_power) AS my, avg(ac_power) AS m, var_pop(ac_power) AS v, covar_pop(ac_power, dc_power) AS c FROM daytime WHERE plant = 1) f""",
    DAY,
)
def m3_dc_power(spark, sf):
    """Direct-current output from one feature; the SQL is the least-squares line."""
    day = B.daytime(spark, sf)
    fitted = M.fit(day.where(F.col("plant") == 1), M.REGRESSORS["Linear Regression"], ["ac_power"], "dc_power")
    return M.predict(fitted, day).select("event_id", rd("predicted"))


@query("m21_dc_leaderboard")
def m21_dc_leaderboard(spark, sf):
    """Models of the direct-current output of plant 1 with seven features: a target that depends on them."""
    train, test = T.training_rows(B.daytime(spark, sf), ["event_id"])
    models = {name: M.REGRESSORS[name] for name in T.MODELS}
    return round_all(M.regression_leaderboard(train, test, models, DC_FEATURES, "dc_power"))


def _share(key: str, digits: int, seed: str = "") -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR){seed}), 1, {digits}) AS BIGINT)"


def _line_metrics(rows: str, fit: str, by: str) -> str:
    """Errors of a line (m, s, n, c, my) on ``rows``, once as it is and once shrunk by the penalty."""
    line = "my + shrink * c / (s * s) * (irradiation - m)"
    return f"""SELECT model, {by} avg(abs(ac_power - ({line}))) AS mae, sqrt(avg((ac_power - ({line})) * (ac_power - ({line})))) AS rmse,
      1 - sum((ac_power - ({line})) * (ac_power - ({line}))) / (var_pop(ac_power) * count(*)) AS r2
      FROM {rows} JOIN (SELECT *, unnest([1.0, n / (n + 1)]) AS shrink, unnest(['Linear Regression', 'Ridge Regression']) AS model FROM {fit}) f
      ON true {'AND f.k = fold' if by else ''} GROUP BY ALL"""


FIT = """CAST(count(*) AS DOUBLE) AS n, avg(ac_power) AS my, avg(irradiation) AS m, stddev_pop(irradiation) AS s, covar_pop(irradiation, ac_power) AS c"""
BOARD_SQL = f"""split AS (SELECT *, {_share('event_id', 15)} < 230584300921369408 AS test, CAST({_share('event_id', 7, " || '|42'")} % 5 AS INTEGER) AS fold
    FROM daytime WHERE plant = 1),
  train AS (SELECT * FROM split WHERE NOT test),
  whole AS (SELECT {FIT} FROM train),
  others AS (SELECT k, {FIT} FROM train JOIN (SELECT unnest(range(5)) AS k) ON fold <> k GROUP BY k),
  held AS ({_line_metrics('(SELECT * FROM split WHERE test)', 'whole', '')}),
  folds AS ({_line_metrics('train', 'others', 'fold,')}),
  cv AS (SELECT model, avg(r2) AS cv_r2, avg(mae) AS cv_mae, stddev_pop(mae) AS cv_mae_std FROM folds GROUP BY 1)"""


@query(
    "m21_line_leaderboard",
    f"""SELECT model, {', '.join(f'{r(c)} AS {c}' for c in ('mae', 'rmse', 'r2', 'cv_r2', 'cv_mae', 'cv_mae_std'))}
      FROM held JOIN cv USING (model)""",
    [*DAY, BOARD_SQL],
)
def m21_line_leaderboard(spark, sf):
    """Leaderboard of the two models with a closed form, on one feature."""
    train, test = T.training_rows(B.daytime(spark, sf), ["event_id"])
    models = {name: M.REGRESSORS[name] for name in ("Linear Regression", "Ridge Regression")}
    return round_all(M.regression_leaderboard(train, test, models, ["irradiation"], T.TARGET))
