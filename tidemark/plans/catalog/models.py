"""Models of two levels that SQL can state, node by node, and audits of the full-size ones."""

from pyspark.ml import classification as C, regression as R
from pyspark.sql import functions as F

from tidemark.functions.sizing import durable
from tidemark.operators import certificates as Z, learning as M, trees as N
from tidemark.operators.forest import Forest
from tidemark.operators.sampling import fold_of
from tidemark.plans import bindings as B
from tidemark.plans.catalog.base import query, r, rd, round_all
from tidemark.plans.catalog.cleaning import RISK_SQL
from tidemark.plans.catalog.learning import BAND, DAYS, FAILURE_SQL, KEY
from tidemark.plans.catalog.statistics import mark_sql


def two_levels_sql(rows: str, key: str, features: tuple[str, ...], label: str) -> str:
    """The tree of two levels that leaves the least sum of squares: nodes, gains and the node of
    every row. ``tree_nodes`` (path, feature, gain), ``placed`` (key, y, p0, p1, p2)."""
    listed = ", ".join(f"CAST({c} AS DOUBLE)" for c in features)
    names = ", ".join(f"'{c}'" for c in features)
    numbers = ", ".join(map(str, range(len(features))))

    def best(level: int) -> str:
        return f"""h{level} AS (SELECT p{level} AS path, f, x, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s FROM long{level} GROUP BY ALL),
        w{level} AS (SELECT path, f, x, sum(n) OVER upto AS ln, sum(s) OVER upto AS ls, sum(n) OVER whole AS wn, sum(s) OVER whole AS ws FROM h{level}
          WINDOW upto AS (PARTITION BY path, f ORDER BY x), whole AS (PARTITION BY path, f)),
        b{level} AS MATERIALIZED (SELECT path, f, x, ls * ls / ln + (ws - ls) * (ws - ls) / (wn - ln) - ws * ws / wn AS gain FROM w{level} WHERE ln < wn
          QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, x) = 1)"""

    return f"""rows0 AS MATERIALIZED (SELECT {key}, CAST({label} AS DOUBLE) AS y, [{listed}] AS xs, '' AS p0 FROM {rows}),
      long0 AS (SELECT p0, y, unnest(xs) AS x, unnest([{numbers}]) AS f FROM rows0), {best(0)},
      rows1 AS MATERIALIZED (SELECT r.*, CASE WHEN xs[f + 1] <= x THEN 'L' ELSE 'R' END AS p1 FROM rows0 r, b0),
      long1 AS (SELECT p1, y, unnest(xs) AS x, unnest([{numbers}]) AS f FROM rows1), {best(1)},
      placed AS MATERIALIZED (SELECT r.*, CASE WHEN b.f IS NULL THEN p1 WHEN xs[f + 1] <= x THEN p1 || 'L' ELSE p1 || 'R' END AS p2
        FROM rows1 r LEFT JOIN b1 b ON path = p1 AND gain > 1e-9),
      splits AS (SELECT path, [{names}][f + 1] AS feature, gain FROM b0 UNION ALL SELECT path, [{names}][f + 1], gain FROM b1 WHERE gain > 1e-9),
      leaves AS (SELECT p2, avg(y) AS value FROM placed GROUP BY p2),
      shares AS (SELECT feature, sum(gain) / (SELECT sum(gain) FROM splits) AS importance FROM splits GROUP BY feature)"""


NODES_SELECT = f"""SELECT path, n, {r('mean')} AS prediction, {r('spread')} AS impurity, feature FROM (
  SELECT unnest(CASE WHEN p1 = p2 THEN [p0, p1] ELSE [p0, p1, p2] END) AS path, count(*) AS n, avg(y) AS mean, {{spread}} AS spread FROM placed GROUP BY 1)
  LEFT JOIN splits USING (path)"""


def node_rows(spark, fitted, features):
    """Path, size, prediction, impurity and feature of every node."""
    named = F.get(F.array(*[F.lit(c) for c in features]), F.col("feature")).alias("feature")
    nodes = N.with_paths(N.node_table(spark, fitted))
    return nodes.select("path", F.col("n").cast("long").alias("n"), rd("prediction"), rd("impurity"), named)


_TWO = {"featuresCol": "features", "labelCol": "label", "maxDepth": 2, "maxBins": 400, "seed": M.SEED}


def two_level_forest(classify=False):
    """A forest of one tree that sees every row."""
    return Forest(trees=1, depth=2, bins=400, classify=classify, bootstrap=False, **M._columns())


# --- output by hour, temperature and day of the week

OUTPUT = ("hour", "ambient_temperature", "week_day")
OUTPUT_VIEWS = [
    B.TELEMETRY_SQL,
    "output AS (SELECT event_id, hour, ambient_temperature, CAST(dayofweek(date) + 1 AS INTEGER) AS week_day, dc_power FROM daytime)",
    two_levels_sql("output", "event_id", OUTPUT, "dc_power"),
]


def output(spark, sf):
    return B.daytime(spark, sf).select("event_id", "hour", "ambient_temperature", F.dayofweek("date").alias("week_day"), "dc_power")


def output_model(rows, build):
    return M.fit(rows, M.Model(lambda f: build()), OUTPUT, "dc_power")


@query("m5_two_levels", NODES_SELECT.format(spread="var_pop(y)"), OUTPUT_VIEWS)
def m5_two_levels(spark, sf):
    """Every node of a regression tree of two levels on three features of few values."""
    fitted = output_model(output(spark, sf), lambda: R.DecisionTreeRegressor(**_TWO))
    return node_rows(spark, fitted, OUTPUT)


OUTPUT_SELECT = f"SELECT event_id, {r('value')} AS predicted FROM placed JOIN leaves USING (p2)"


@query("m6_two_levels", OUTPUT_SELECT, OUTPUT_VIEWS)
def m6_two_levels(spark, sf):
    """Prediction of every reading by a forest of one tree of two levels, without bagging."""
    rows = output(spark, sf)
    return M.predict(output_model(rows, two_level_forest), rows).select("event_id", rd("predicted"))


@query("m7_two_levels", OUTPUT_SELECT, OUTPUT_VIEWS)
def m7_two_levels(spark, sf):
    """The same by one round of boosting."""
    rows = output(spark, sf)
    return M.predict(output_model(rows, lambda: R.GBTRegressor(**_TWO, maxIter=1)), rows).select("event_id", rd("predicted"))


@query(
    "m16_three_features",
    f"""SELECT model, feature, {r('coalesce(importance, 0)')} AS importance
      FROM (SELECT unnest(['tree', 'forest']) AS model), (SELECT unnest([{', '.join(f"'{c}'" for c in OUTPUT)}]) AS feature) LEFT JOIN shares USING (feature)""",
    OUTPUT_VIEWS,
)
def m16_three_features(spark, sf):
    """Importances of three features, of a tree from its node table and of a forest."""
    rows = durable(output(spark, sf))
    tree = output_model(rows, lambda: R.DecisionTreeRegressor(**_TWO))
    of_tree = N.importances_of(N.node_table(spark, tree), OUTPUT).withColumn("model", F.lit("tree"))
    of_forest = M.importances(output_model(rows, two_level_forest), rows).withColumn("model", F.lit("forest"))
    return round_all(of_tree.unionByName(of_forest).select("model", "feature", "importance"))


# --- machine failure by coarse bands of risk, days and load

BANDS = ("risk_tenth", "month", "load_band")
BANDS_VIEWS = [
    B.MACHINES_SQL,
    RISK_SQL,
    FAILURE_SQL,
    f"bands AS (SELECT {KEY}, floor(10 * round(risk_score, 6)) AS risk_tenth, floor({DAYS} / 30) AS month, floor(load_pct / 10) AS load_band, failure FROM failing)",
    two_levels_sql("bands", KEY, BANDS, "failure"),
]


def bands(spark, sf):
    band = {"risk_tenth": F.floor(10 * F.round("risk_score", 6)), "month": F.floor(F.col(DAYS) / 30), "load_band": F.floor(F.col("load_pct") / 10)}
    return B.labelled_machines(spark, sf).select(*B.MACHINE_KEY, *[c.cast("double").alias(k) for k, c in band.items()], "failure")


def bands_model(rows, build):
    return M.fit(rows, M.Model(lambda f: build()), BANDS, "failure")


@query("m8_two_levels", NODES_SELECT.format(spread="2 * avg(y) * (1 - avg(y))").replace(r("mean"), "CAST(mean > 0.5 AS DOUBLE)"), BANDS_VIEWS)
def m8_two_levels(spark, sf):
    """Every node of a classification tree of two levels: its class and Gini impurity."""
    fitted = bands_model(bands(spark, sf), lambda: C.DecisionTreeClassifier(**_TWO))
    return node_rows(spark, fitted, BANDS)


SCORE_SELECT = f"SELECT {KEY}, CAST({{v}} > 0.5 AS INTEGER) AS prediction, {r('{v}')} AS score FROM placed JOIN leaves USING (p2)"


@query("m11_two_levels", SCORE_SELECT.format(v="value"), BANDS_VIEWS)
def m11_two_levels(spark, sf):
    """Class and score of every reading by a forest of one tree of two levels, without bagging."""
    rows = bands(spark, sf)
    fitted = bands_model(rows, lambda: two_level_forest(classify=True))
    return M.classify(fitted, rows).select(*B.MACHINE_KEY, F.col("prediction").cast("int"), rd("score"))


@query("m12_two_levels", SCORE_SELECT.format(v="(1 / (1 + exp(-2 * (2 * value - 1))))"), BANDS_VIEWS)
def m12_two_levels(spark, sf):
    """The same by one round of boosting on the label as -1 and 1."""
    rows = bands(spark, sf)
    fitted = bands_model(rows, lambda: C.GBTClassifier(**_TWO, maxIter=1))
    return M.classify(fitted, rows).select(*B.MACHINE_KEY, F.col("prediction").cast("int"), rd("score"))


# --- audits: what all rows say about full-size models

AUDIT_SELECT = """SELECT CAST({n} AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_other_size, CAST(0 AS BIGINT) AS n_other_mean,
  CAST(0 AS BIGINT) AS n_other_impurity, CAST(0 AS BIGINT) AS n_better_split"""


@query("m5_tree_audit", AUDIT_SELECT.format(n="(SELECT count(DISTINCT l_partkey) FROM lineitem)"))
def m5_tree_audit(spark, sf):
    """The full regression tree of the remaining days: no node's number, mean or variance differs
    from that of the rows that come through it, and no other split would gain more."""
    rows = durable(B.labelled_assets(spark, sf).select(*B.FEATURES, "RUL_days"))
    fitted = M.fit(rows, M.REGRESSORS["Decision Tree"], B.FEATURES, "RUL_days")
    nodes = durable(N.node_table(spark, fitted))
    audit = durable(N.split_audit(rows, nodes, B.FEATURES, "RUL_days"))
    whole = audit.where("node = 0").select(F.col("n").alias("n_rows"))
    return _beside(whole, N.audit_summary(audit, nodes))


def _beside(whole, summary):
    """Two tables of one row as one."""
    counts = [c for c in summary.columns if c != "n_nodes"]
    row = summary.select(F.struct(*counts).alias("s")).scalar()
    return whole.withColumn("s", row).select("n_rows", "s.*")


@query(
    "m10_failure_margin",
    "SELECT count(*) AS n, CAST(0 AS DOUBLE) AS slope FROM machines",
    [B.MACHINES_SQL],
)
def m10_failure_margin(spark, sf):
    """Maximum-margin model of failure: at the fitted weights the slope of the loss over all
    readings may be zero."""
    rows = durable(B.labelled_machines(spark, sf).select("risk_score", DAYS, "failure"))
    fitted = M.fit(rows, M.CLASSIFIERS["Linear SVC"], ["risk_score", DAYS], "failure")
    return Z.margin_certificate(fitted, rows, "failure").select("n", rd("slope", 3))


@query("m13_network_pass", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM documents")
def m13_network_pass(spark, sf):
    """Network of document quality: the scores of all documents are those of the fitted weights,
    passed forward layer by layer."""
    rows = durable(B.all_doc_features(spark, sf).select(*B.DOC_FEATURES, "quality"))
    fitted = M.fit(rows.where("quality IS NOT NULL"), M.CLASSIFIERS["MLP Neural Network"], B.DOC_FEATURES, "quality")
    return Z.network_certificate(fitted, rows, "quality").select("n", "n_different")


# --- the area under the curve, cross-validated

FAILING_FOLDS = f"""folded AS (SELECT {DAYS} AS x, CAST(failure AS DOUBLE) AS y,
  CAST(('0x' || substr({mark_sql(" || '|' || ".join(f'CAST({k} AS VARCHAR)' for k in B.MACHINE_KEY))}, 1, 7))::BIGINT % 5 AS INTEGER) AS fold FROM failing)"""


@query(
    "m20_cv_auc",
    f"""SELECT {r('avg(auc)')} AS cv_auc FROM (
      SELECT fold, (sum(CASE WHEN y = 1 THEN rk END) - p * (p + 1) / 2) / (p * q) AS auc FROM (
        SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY score) + (count(*) OVER (PARTITION BY fold, score) - 1) / 2 AS rk,
          CAST(count(*) FILTER (y = 1) OVER (PARTITION BY fold) AS DOUBLE) AS p, CAST(count(*) FILTER (y = 0) OVER (PARTITION BY fold) AS DOUBLE) AS q
        FROM (SELECT v.fold, v.y, sign(l.b) * v.x AS score FROM folded v JOIN (
          SELECT k.fold, regr_slope(f.y, f.x) AS b FROM (SELECT DISTINCT fold FROM folded) k JOIN folded f ON f.fold <> k.fold GROUP BY 1) l ON l.fold = v.fold))
      GROUP BY fold, p, q)""",
    [B.MACHINES_SQL, RISK_SQL, FAILURE_SQL, FAILING_FOLDS],
)
def m20_cv_auc(spark, sf):
    """Mean area under the curve over five folds, of a line fitted to the others; a line ranks
    as its feature does, up to the sign of its slope."""
    rows = B.labelled_machines(spark, sf)
    folded = durable(rows.select(DAYS, "failure", fold_of([F.col(k) for k in B.MACHINE_KEY]).alias("fold")))
    scored = M.linear_folds(folded, DAYS, "failure").withColumn("model", F.lit("line"))
    return round_all(M.cross_validated_auc(scored, "failure", "predicted").select("cv_auc"))
