"""Correlations, trends and chart frames."""

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import sampling as L, statistics as S
from tidemark.operators.monitoring import score_rows
from tidemark.plans import bindings as B, customers as C, eda
from tidemark.plans.catalog.base import query, r, rd, round_all
from tidemark.plans.catalog.grouping import mark_sql
from tidemark.plans.catalog.joining import MERGED_VIEWS, merged

TELEMETRY = [B.TELEMETRY_SQL]
COLUMNS = (
    "ac_power", "dc_power", "daily_yield", "ambient_temperature", "module_temperature",
    "irradiation", "hour",
)
PAIRS = S.lower_pairs(COLUMNS)


def _corr_sql(source: str, name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT plant, '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS {name} FROM {source} GROUP BY 1"
        for a, b in PAIRS
    )


RANKS_SQL = "ranked AS (SELECT plant, {} FROM daytime)".format(
    ", ".join(
        f"rank() OVER (PARTITION BY plant ORDER BY {c}) + (count(*) OVER (PARTITION BY plant, {c}) - 1) / 2 AS {c}"
        for c in COLUMNS
    )
)
PEARSON_SQL = f"pearsons AS ({_corr_sql('daytime', 'pearson')})"
SPEARMAN_SQL = f"spearmans AS ({_corr_sql('ranked', 'spearman')})"
BEST_SQL = """best AS (
  SELECT plant, p.row, p.col, CASE WHEN abs(spearman) > abs(pearson) THEN spearman ELSE pearson END AS corr,
    CASE WHEN abs(spearman) > abs(pearson) THEN 'S' ELSE 'P' END AS method
  FROM pearsons p JOIN spearmans s USING (plant, row, col))"""
CORRELATIONS = [B.TELEMETRY_SQL, RANKS_SQL, PEARSON_SQL, SPEARMAN_SQL, BEST_SQL]


def best(spark, sf):
    return eda.correlations(B.daytime(spark, sf), COLUMNS, ["plant"])


@query("t1_pearson", f"SELECT plant, row, col, {r('pearson')} AS pearson FROM pearsons", CORRELATIONS)
def t1_pearson(spark, sf):
    return round_all(S.pearson(B.daytime(spark, sf), COLUMNS, ["plant"]))


@query("t2_spearman", f"SELECT plant, row, col, {r('spearman')} AS spearman FROM spearmans", CORRELATIONS)
def t2_spearman(spark, sf):
    return round_all(S.spearman(B.daytime(spark, sf), COLUMNS, ["plant"], complete=True))


@query(
    "t2_spearman_incomplete",
    f"""SELECT 'b' AS "row", 'a' AS col, {r('corr(ra, rb)')} AS spearman FROM (
      SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 AS ra,
        rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 AS rb
      FROM (SELECT c_acctbal AS a, TRY_CAST(Age AS DOUBLE) AS b FROM customer c JOIN people p ON c.c_custkey = p.c_custkey)
      WHERE a IS NOT NULL AND b IS NOT NULL)""",
    [B.CUSTOMERS_SQL],
)
def t2_spearman_incomplete(spark, sf):
    """Rank correlation over the complete rows of a pair with missing cells."""
    ages = B.people(spark, sf).select("c_custkey", X.to_number(F.col("Age")).alias("b"))
    rows = B.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("a"))
    return round_all(S.spearman(rows.join(ages, "c_custkey"), ["a", "b"]))


@query("t3_best_corr", f"SELECT plant, row, col, {r('corr')} AS corr, method FROM best", CORRELATIONS)
def t3_best_corr(spark, sf):
    return round_all(best(spark, sf))


@query(
    "t5_rank",
    f"""SELECT plant, CASE WHEN row = 'ac_power' THEN col ELSE row END AS feature, {r('corr')} AS correlation, method
      FROM best WHERE row = 'ac_power' OR col = 'ac_power' ORDER BY plant, abs(corr) DESC""",
    CORRELATIONS,
)
def t5_rank(spark, sf):
    return round_all(S.feature_ranking(best(spark, sf), "ac_power", ["plant"]))


@query(
    "t4_lower_triangle",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"row\", '{b}' AS col, {r(f'corr({a}, {b})', 2)} AS pearson FROM machines"
        for a, b in S.lower_pairs(B.SENSORS)
    ),
    [B.MACHINES_SQL],
)
def t4_lower_triangle(spark, sf):
    """Only the cells below the diagonal, without groups."""
    return round_all(S.pearson(B.machines(spark, sf), B.SENSORS), 2)


TREND_SQL = """daily AS (SELECT plant, date, max(daily_yield) AS y, sum(irradiation) AS x FROM telemetry GROUP BY 1, 2),
trend AS (SELECT plant, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2,
  min(x) AS x_min, max(x) AS x_max FROM daily GROUP BY 1)"""


def _trend(spark, sf):
    daily = B.telemetry(spark, sf).groupBy("plant", "date").agg(
        F.max("daily_yield").alias("y"), F.sum("irradiation").alias("x")
    )
    return S.linear_trend(daily, "x", "y", ["plant"])


@query(
    "t6_trend",
    f"""SELECT plant, {r('slope')} AS slope, {r('intercept')} AS intercept, {r('r2')} AS r2, {r('x_min')} AS x_min,
      {r('x_max')} AS x_max FROM trend""",
    [*TELEMETRY, TREND_SQL],
)
def t6_trend(spark, sf):
    """Trend of daily yield on daily irradiation."""
    return round_all(_trend(spark, sf))


@query(
    "t8_grid",
    f"""SELECT plant, CAST(point AS INTEGER) AS point, {r('x')} AS x, {r('intercept + slope * x')} AS y
      FROM (SELECT *, x_min + point * ((x_max - x_min) / 99) AS x FROM trend, (SELECT unnest(range(100)) AS point))""",
    [*TELEMETRY, TREND_SQL],
)
def t8_grid(spark, sf):
    return round_all(S.trend_line(_trend(spark, sf), 100, ["plant"]))


def _fits_sql(source: str, by: str) -> str:
    """Degree fits of every pair by solving for the part of z² orthogonal to 1 and z."""
    points = " UNION ALL ".join(
        f"SELECT {by}, '{x}' AS x_name, '{y}' AS y_name, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source}"
        for x, y in eda.TREND_PAIRS
    )
    return f"""points AS ({points}),
    std AS (SELECT {by}, x_name, y_name, x, y, avg(x) OVER w AS mx, stddev_pop(x) OVER w AS sx, avg(y) OVER w AS my
      FROM points WINDOW w AS (PARTITION BY {by}, x_name, y_name)),
    z AS (SELECT {by}, x_name, y_name, x, mx, sx, my, (x - mx) / sx AS z, y - my AS v FROM std),
    m AS (SELECT {by}, x_name, y_name, max(mx) AS mx, max(sx) AS sx, max(my) AS my, min(x) AS x_min, max(x) AS x_max,
        avg(z * z * z) AS m3, avg(z * z * z * z) AS m4, avg(z * v) AS c1, avg(z * z * v) AS c2, avg(v * v) AS vv
      FROM z GROUP BY ALL),
    fits AS (SELECT *, c1 * c1 / vv AS r1, CASE WHEN m4 - 1 - m3 * m3 > 1e-9 THEN (c2 - m3 * c1) / (m4 - 1 - m3 * m3) ELSE 0 END AS bq,
      CASE WHEN m4 - 1 - m3 * m3 > 1e-9 THEN (c2 - m3 * c1) * (c2 - m3 * c1) / (m4 - 1 - m3 * m3) / vv ELSE 0 END AS gain2 FROM m),
    chosen AS (SELECT *, CASE WHEN gain2 > 0.05 THEN 2 WHEN r1 > 0.05 THEN 1 ELSE 0 END AS best_degree FROM fits)"""


DEGREE_SELECT = f"""SELECT plant, x_name || ' -> ' || y_name AS pair, CAST(best_degree AS INTEGER) AS best_degree,
  {r('CASE best_degree WHEN 2 THEN r1 + gain2 WHEN 1 THEN r1 ELSE 0 END')} AS r2 FROM chosen"""


@query("t7_best_degree", DEGREE_SELECT, [B.TELEMETRY_SQL, _fits_sql("daytime", "plant")])
def t7_best_degree(spark, sf):
    fits = S.best_degree(B.daytime(spark, sf), eda.TREND_PAIRS, ["plant"])
    return round_all(fits.select("plant", "pair", "best_degree", "r2"))


@query(
    "t7_curve",
    f"""SELECT plant, x_name || ' -> ' || y_name AS pair, CAST(point AS INTEGER) AS point, {r('x', 3)} AS x,
      {r('my + CASE best_degree WHEN 2 THEN c1 * t + bq * (t * t - 1 - m3 * t) WHEN 1 THEN c1 * t ELSE 0 END', 3)} AS y
      FROM (SELECT *, (x - mx) / sx AS t FROM (SELECT *, x_min + point * ((x_max - x_min) / 299) AS x
        FROM chosen, (SELECT unnest(range(300)) AS point)))""",
    [B.TELEMETRY_SQL, _fits_sql("daytime", "plant")],
)
def t7_curve(spark, sf):
    """The chosen curves on a 300-point grid."""
    fits = S.best_degree(B.daytime(spark, sf), eda.TREND_PAIRS, ["plant"])
    return round_all(S.degree_curve(fits, 300, ["plant"]), 3)


SUMMARY_SQL = """summary AS (SELECT CustomerID, CustomerGroup, AgeGroup, coalesce(sum(Price), 0) AS Sum_Price,
  count(DISTINCT ProductNr) AS Unique_ProductNr FROM merged GROUP BY 1, 2, 3)"""
PARALLEL_SQL = """coded AS (SELECT CustomerGroup, CASE AgeGroup WHEN 'Adolescent' THEN 0 WHEN 'Adult' THEN 1 ELSE 2 END AS AgeGroup,
  dense_rank() OVER (ORDER BY CustomerGroup) - 1 AS CustomerGroup_num, Sum_Price, Unique_ProductNr FROM summary),
axes AS ({})""".format(
    " UNION ALL ".join(
        f"""SELECT CustomerGroup, '{a}' AS axis, ({a} - (SELECT min({a}) FROM coded))
        / ((SELECT max({a}) - min({a}) FROM coded) + 1e-9) AS value FROM coded"""
        for a in C.PARALLEL_AXES
    )
)
SUMMARY_VIEWS = [*MERGED_VIEWS, SUMMARY_SQL]


@query(
    "t9_parallel_lines",
    f'SELECT CustomerGroup AS "CustomerGroup", axis, {r("value")} AS value FROM axes',
    [*SUMMARY_VIEWS, PARALLEL_SQL],
)
def t9_parallel_lines(spark, sf):
    return round_all(C.parallel_frame(C.per_customer(merged(spark, sf)))[0])


@query(
    "t9_parallel_medians",
    f'SELECT CustomerGroup AS "CustomerGroup", axis, {r("median(value)")} AS median FROM axes GROUP BY 1, 2',
    [*SUMMARY_VIEWS, PARALLEL_SQL],
)
def t9_parallel_medians(spark, sf):
    return round_all(C.parallel_frame(C.per_customer(merged(spark, sf)))[1])


@query(
    "t10_scatter",
    f"""SELECT CustomerGroup AS "CustomerGroup", Unique_ProductNr AS "Unique_ProductNr",
      {r('Sum_Price', 2)} AS "Sum_Price" FROM summary""",
    SUMMARY_VIEWS,
)
def t10_scatter(spark, sf):
    return round_all(C.scatter_frame(C.per_customer(merged(spark, sf))), 2)


@query(
    "t10_group_counts",
    'SELECT CustomerGroup AS "CustomerGroup", count(*) AS count FROM summary GROUP BY 1',
    SUMMARY_VIEWS,
)
def t10_group_counts(spark, sf):
    return C.group_counts(C.per_customer(merged(spark, sf)))


SAMPLE_SQL = f"""sample AS (SELECT * FROM daytime
  QUALIFY row_number() OVER (PARTITION BY plant ORDER BY {mark_sql('event_id')}, event_id) <= 3000)"""


@query(
    "t11_pairs",
    " UNION ALL ".join(
        f"""SELECT plant, event_id, '{x} -> {y}' AS pair, CAST({x} AS DOUBLE) AS x, {r(y)} AS y FROM sample"""
        for x, y in eda.TREND_PAIRS
    ),
    [B.TELEMETRY_SQL, SAMPLE_SQL],
)
def t11_pairs(spark, sf):
    """Points of the pair charts (sampling operator: 3,000 rows of each plant)."""
    points = eda.pair_report(B.daytime(spark, sf), eda.TREND_PAIRS, ["event_id"], ["plant"], ["points"])["points"]
    return points.withColumn("y", rd("y"))


@query("t11_sample_trends", DEGREE_SELECT, [B.TELEMETRY_SQL, SAMPLE_SQL, _fits_sql("sample", "plant")])
def t11_sample_trends(spark, sf):
    """Chosen trend of every pair chart, fitted on its sample."""
    fits = eda.pair_report(B.daytime(spark, sf), eda.TREND_PAIRS, ["event_id"], ["plant"], ["trends"])["trends"]
    return round_all(fits.select("plant", "pair", "best_degree", "r2"))


@query(
    "t11_axis_limits",
    " UNION ALL ".join(
        f"""SELECT plant, '{c}' AS "column", {r(f'quantile_cont({c}, 0.01)')} AS low,
        {r(f'quantile_cont({c}, 0.99)')} AS high FROM daytime GROUP BY 1"""
        for c in sorted({c for pair in eda.TREND_PAIRS for c in pair})
    ),
    TELEMETRY,
)
def t11_axis_limits(spark, sf):
    limits = eda.pair_report(B.daytime(spark, sf), eda.TREND_PAIRS, ["event_id"], ["plant"], ["limits"])["limits"]
    return round_all(limits)


@query(
    "t12_points",
    f"""SELECT event_id, pair, {r('x')} AS x, {r('y')} AS y FROM (
      SELECT event_id, actual AS a, predicted AS p, error AS e FROM rated ORDER BY {mark_sql('event_id')}, event_id LIMIT 2000),
      LATERAL (SELECT 'actual -> predicted' AS pair, a AS x, p AS y UNION ALL SELECT 'predicted -> error', p, e)""",
    [B.TELEMETRY_SQL, B.SCORED_SQL],
)
def t12_points(spark, sf):
    """Actual against predicted and predicted against residual (sampling operator: 2,000 rows)."""
    sample = L.sample_rows(score_rows(B.scored(spark, sf)), 2000, ["event_id"])
    pairs = [("actual", "predicted"), ("predicted", "error")]
    return round_all(S.point_pairs(sample, pairs, ["event_id"]))
