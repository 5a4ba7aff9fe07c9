"""Projections, filters, cleaning."""

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import cleaning as P, monitoring as Q
from tidemark.operators.joins import stack_tables
from tidemark.plans import bindings as B, customers as C, telemetry as T
from tidemark.plans.catalog.base import query, r, rd, round_all

SYSTEMS = [B.CUSTOMERS_SQL]
FIRST_SQL = """first1 AS (
  SELECT * FROM system1 QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY row_no) = 1)"""
ANY_FIRST_SQL = FIRST_SQL.replace("first1", "first").replace("system1", "systems")


@query(
    "p1_crop",
    "SELECT * FROM systems WHERE row_no > (SELECT max(row_no) FROM (SELECT row_no FROM systems ORDER BY row_no LIMIT 1))",
    SYSTEMS,
)
def p1_crop(spark, sf):
    """Drop one leading row and one leading column; padded names are trimmed (P2)."""
    return P.crop(B.padded(B.systems(spark, sf)), 1, 1, ["` row_no `"])


@query("p2_trim_names", "SELECT 'x' AS \"Unnamed\", * FROM systems", SYSTEMS)
def p2_trim_names(spark, sf):
    return P.strip_names(B.padded(B.systems(spark, sf)))


@query("p3_select", "SELECT o_orderkey, o_totalprice FROM orders")
def p3_select(spark, sf):
    return B.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@query("p4_drop", "SELECT * EXCLUDE (o_orderstatus, o_orderpriority) FROM orders")
def p4_drop(spark, sf):
    return B.table(spark, sf, "orders").drop("o_orderstatus", "o_orderpriority")


@query("p5_rename", 'SELECT o_custkey AS "CustomerID", o_totalprice AS "Price" FROM orders')
def p5_rename(spark, sf):
    return B.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("CustomerID"), F.col("o_totalprice").alias("Price")
    )


@query("p6_daytime", "SELECT event_id, irradiation FROM daytime", [B.TELEMETRY_SQL])
def p6_daytime(spark, sf):
    return T.daytime(B.telemetry(spark, sf)).select("event_id", "irradiation")


@query(
    "p7_group_value",
    "SELECT plant, source_key, count(*) AS n FROM telemetry WHERE event_type = 'error' GROUP BY 1, 2",
    [B.TELEMETRY_SQL],
)
def p7_group_value(spark, sf):
    rows = B.telemetry(spark, sf).where(F.col("event_type") == "error")
    return rows.groupBy("plant", "source_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p8_under_performers",
    f"""SELECT plant, source_key, {r('avg(perf_ratio)')} AS perf_ratio FROM rated
      GROUP BY 1, 2 HAVING avg(perf_ratio) < 0.85""",
    [B.TELEMETRY_SQL, B.SCORED_SQL],
)
def p8_under_performers(spark, sf):
    means = Q.score_rows(B.scored(spark, sf)).groupBy("plant", "source_key").agg(
        F.avg("perf_ratio").alias("perf_ratio")
    )
    return means.where(F.col("perf_ratio") < X.UNDER_THRESHOLD).withColumn(
        "perf_ratio", rd("perf_ratio")
    )


@query(
    "p9_drop_missing",
    """SELECT c_custkey, Age, Email FROM people WHERE Age IS NOT NULL AND Email IS NOT NULL""",
    SYSTEMS,
)
def p9_drop_missing(spark, sf):
    rows = B.people(spark, sf).select("c_custkey", "Age", "Email")
    return rows.na.drop(subset=["Age", "Email"])


@query("p10_dedup_first", "SELECT * FROM first", [*SYSTEMS, ANY_FIRST_SQL])
def p10_dedup_first(spark, sf):
    return P.dedupe(B.systems(spark, sf), ["CustomerID"], ["row_no"])


@query(
    "p10_dedup_last",
    """SELECT * FROM systems
      QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY row_no DESC) = 1""",
    SYSTEMS,
)
def p10_dedup_last(spark, sf):
    return P.dedupe(B.systems(spark, sf), ["CustomerID"], ["row_no"], keep="last")


@query(
    "p10_dedup_none",
    "SELECT * FROM systems QUALIFY count(*) OVER (PARTITION BY CustomerID) = 1",
    SYSTEMS,
)
def p10_dedup_none(spark, sf):
    return P.dedupe(B.systems(spark, sf), ["CustomerID"], ["row_no"], keep="none")


@query(
    "p10_removed_count",
    """SELECT (SELECT count(*) FROM systems) AS rows_before, count(*) AS rows_after,
      (SELECT count(*) FROM systems) - count(*) AS rows_removed FROM first""",
    [*SYSTEMS, ANY_FIRST_SQL],
)
def p10_removed_count(spark, sf):
    rows = B.systems(spark, sf)
    return P.removed_rows(rows, P.dedupe(rows, ["CustomerID"], ["row_no"]))


@query("p11_coerce", 'SELECT row_no, TRY_CAST(Age AS DOUBLE) AS "Age" FROM systems', SYSTEMS)
def p11_coerce(spark, sf):
    return B.systems(spark, sf).select("row_no", X.to_number(F.col("Age")).alias("Age"))


def _imputed(strategy):
    def run(spark, sf):
        rows = P.impute(B.systems(spark, sf), "Age", strategy)
        return rows.select("row_no", rd("Age"))

    return run


def _imputed_sql(fill: str) -> str:
    rounded_fill = r(f"(SELECT {fill} FROM ages)", 2)
    return f'SELECT row_no, {r(f"coalesce(a, {rounded_fill})")} AS "Age" FROM ages'


AGES_SQL = "ages AS (SELECT row_no, TRY_CAST(Age AS DOUBLE) AS a FROM systems)"
for _name, _strategy, _fill in [
    ("p12_impute_mean", "mean", "avg(a)"),
    ("p12_impute_median", "median", "median(a)"),
    ("p12_impute_const", 41.5, "max(41.5)"),
]:
    query(_name, _imputed_sql(_fill), [*SYSTEMS, AGES_SQL])(_imputed(_strategy))
query(
    "p12_impute_mode",
    f"""SELECT row_no, {r('coalesce(a, (SELECT a FROM ages WHERE a IS NOT NULL GROUP BY a ORDER BY count(*) DESC, a LIMIT 1))')}
      AS "Age" FROM ages""",
    [*SYSTEMS, AGES_SQL],
)(_imputed("mode"))


@query(
    "p13_bucket",
    """SELECT row_no, CASE WHEN a < 18 THEN 'Adolescent' WHEN a <= 65 THEN 'Adult'
      WHEN a IS NOT NULL THEN 'Older Adult' END AS "AgeGroup" FROM ages""",
    [*SYSTEMS, AGES_SQL],
)
def p13_bucket(spark, sf):
    age = X.to_number(F.col("Age"))
    return B.systems(spark, sf).select("row_no", X.age_group(age).alias("AgeGroup"))


@query(
    "p14_status",
    """SELECT event_id, CASE WHEN perf_ratio < 0.85 THEN 'Under' ELSE 'Normal' END AS status FROM rated""",
    [B.TELEMETRY_SQL, B.SCORED_SQL],
)
def p14_status(spark, sf):
    rows = Q.score_rows(B.scored(spark, sf))
    return rows.select("event_id", X.status(F.col("perf_ratio")).alias("status"))


@query(
    "p15_coalesce",
    'SELECT c_custkey, coalesce(Email, CorporateEmail) AS "Email" FROM people',
    SYSTEMS,
)
def p15_coalesce(spark, sf):
    return P.fallback(B.people(spark, sf), "Email", "CorporateEmail").select("c_custkey", "Email")


@query(
    "p16_fill_zero",
    "SELECT c_custkey, coalesce(TRY_CAST(Age AS DOUBLE), 0) AS age FROM people",
    SYSTEMS,
)
def p16_fill_zero(spark, sf):
    rows = B.people(spark, sf).select("c_custkey", X.to_number(F.col("Age")).alias("age"))
    return rows.na.fill(0.0, ["age"])


@query(
    "p17_to_text",
    'SELECT c_custkey, CAST(Newsletter AS VARCHAR) AS "Newsletter" FROM people',
    SYSTEMS,
)
def p17_to_text(spark, sf):
    return B.people(spark, sf).select(
        "c_custkey", F.col("Newsletter").cast("string").alias("Newsletter")
    )


TRANSFORMED_SQL = """stacked AS (
  SELECT row_no, CustomerID, Country, Email, CorporateEmail, Newsletter,
    coalesce(TRY_CAST(Age AS DOUBLE), (SELECT CAST(round(CAST(avg(TRY_CAST(Age AS DOUBLE)) AS DECIMAL(30,8)), 2) AS DOUBLE) FROM first1)) AS Age
  FROM first1
  UNION ALL BY NAME
  SELECT row_no, CustomerID, Country, Email, CorporateEmail, Newsletter,
    coalesce(TRY_CAST(Age AS DOUBLE), (SELECT CAST(round(CAST(avg(TRY_CAST(Age AS DOUBLE)) AS DECIMAL(30,8)), 2) AS DOUBLE) FROM first2)) AS Age
  FROM first2),
customers AS (
  SELECT row_no, split_part(CustomerID, '_', 2) AS CustomerID, Age, replace(Country, ',', ' ') AS Country,
    coalesce(Email, CorporateEmail) AS Email, CorporateEmail, CAST(Newsletter AS VARCHAR) AS Newsletter,
    CASE WHEN Age < 18 THEN 'Adolescent' WHEN Age <= 65 THEN 'Adult' ELSE 'Older Adult' END AS AgeGroup,
    split_part(CustomerID, '_', 1) AS CustomerGroup
  FROM stacked)"""
SECOND_SQL = FIRST_SQL.replace("first1", "first2").replace("system1", "system2")
CUSTOMER_VIEWS = [*SYSTEMS, FIRST_SQL, SECOND_SQL, TRANSFORMED_SQL]


def customers(spark, sf):
    """Both customer systems, cleaned, transformed and stacked (no row is cropped)."""
    first = C.transform(C.clean(B.padded(B.system1(spark, sf)), [" row_no "], 0, 1))
    second = C.transform(C.clean(B.system2(spark, sf), ["row_no"]))
    return stack_tables(first.drop("c_custkey"), second.drop("c_custkey"))


@query(
    "u1_union",
    f"""SELECT row_no, CustomerID AS "CustomerID", {r('Age')} AS "Age", Country AS "Country", Email AS "Email",
      CorporateEmail AS "CorporateEmail", Newsletter AS "Newsletter", AgeGroup AS "AgeGroup",
      CustomerGroup AS "CustomerGroup" FROM customers""",
    CUSTOMER_VIEWS,
)
def u1_union(spark, sf):
    """Clean and transform both systems (P10-P18, X1, X2) and stack them."""
    return round_all(customers(spark, sf))


@query(
    "u1_union_missing_columns",
    """SELECT row_no, Country AS "Country", Newsletter AS "Newsletter" FROM
      (SELECT row_no, Country, NULL AS Newsletter FROM system1
       UNION ALL SELECT row_no, NULL, Newsletter FROM system2)""",
    SYSTEMS,
)
def u1_union_missing_columns(spark, sf):
    return stack_tables(
        B.system1(spark, sf).select("row_no", "Country"),
        B.system2(spark, sf).select("row_no", "Newsletter"),
    )


@query(
    "p18_optional_columns",
    """SELECT row_no, split_part(CustomerID, '_', 2) AS "CustomerID",
      split_part(CustomerID, '_', 1) AS "CustomerGroup" FROM systems""",
    SYSTEMS,
)
def p18_optional_columns(spark, sf):
    """The transformation skips every column a table lacks."""
    return C.transform(B.systems(spark, sf).select("row_no", "CustomerID"))


@query(
    "p19_errors",
    f"SELECT event_id, {r('error')} AS error, {r('abs_error')} AS abs_error FROM rated",
    [B.TELEMETRY_SQL, B.SCORED_SQL],
)
def p19_errors(spark, sf):
    return Q.score_rows(B.scored(spark, sf)).select("event_id", rd("error"), rd("abs_error"))


@query(
    "p20_perf_ratio",
    f"SELECT event_id, {r('perf_ratio')} AS perf_ratio FROM rated",
    [B.TELEMETRY_SQL, B.SCORED_SQL],
)
def p20_perf_ratio(spark, sf):
    return Q.score_rows(B.scored(spark, sf)).select("event_id", rd("perf_ratio"))


@query(
    "p21_ape",
    f"""SELECT event_id, {r('abs(actual - predicted) / nullif(actual, 0) * 100', 2)} AS ape FROM scored2""",
    [B.TELEMETRY_SQL, B.SCORED_SQL,
     "scored2 AS (SELECT event_id, predicted, CASE WHEN event_id % 31 = 0 THEN 0 ELSE actual END AS actual FROM scored)"],
)
def p21_ape(spark, sf):
    """Percentage error; some actual values are zero."""
    actual = F.when(F.col("event_id") % 31 == 0, 0.0).otherwise(F.col("actual"))
    error = X.percentage_error(actual, F.col("predicted"))
    return B.scored(spark, sf).select("event_id", rd(error, 2).alias("ape"))


@query(
    "p22_ordinal",
    """SELECT c_custkey, CAST(CASE AgeGroup WHEN 'Adolescent' THEN 0 WHEN 'Adult' THEN 1 WHEN 'Older Adult' THEN 2 END AS INTEGER) AS age_code,
      CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment_code
      FROM (SELECT c_custkey, c_mktsegment, CASE WHEN a < 18 THEN 'Adolescent' WHEN a <= 65 THEN 'Adult' WHEN a IS NOT NULL THEN 'Older Adult' END AS AgeGroup
        FROM (SELECT c.c_custkey, c_mktsegment, TRY_CAST(Age AS DOUBLE) AS a FROM customer c JOIN people p ON c.c_custkey = p.c_custkey))""",
    SYSTEMS,
)
def p22_ordinal(spark, sf):
    """Codes by a given order and by sorted order."""
    ages = B.people(spark, sf).select(
        "c_custkey", X.age_group(X.to_number(F.col("Age"))).alias("AgeGroup")
    )
    rows = B.table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(ages, "c_custkey")
    coded = P.encode_sorted(rows, "c_mktsegment", "segment_code")
    return coded.select(
        "c_custkey", P.encode_fixed("AgeGroup", X.AGE_LABELS).alias("age_code"), "segment_code"
    )


@query(
    "p23_minmax",
    f"""SELECT p_partkey,
      {r('(p_size - (SELECT min(p_size) FROM part)) / ((SELECT max(p_size) - min(p_size) FROM part) + 1e-9)')} AS p_size,
      {r('(p_retailprice - (SELECT min(p_retailprice) FROM part)) / ((SELECT max(p_retailprice) - min(p_retailprice) FROM part) + 1e-9)')} AS p_retailprice
      FROM part""",
)
def p23_minmax(spark, sf):
    rows = B.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return round_all(P.scale_unit(rows, ["p_size", "p_retailprice"]))


RISK_SQL = """risk AS (
  SELECT *, least(greatest(0.30 * (operating_hours / 8760)
    + 0.25 * (vibration_mms / (SELECT max(vibration_mms) FROM machines))
    + 0.20 * least(greatest((temperature_C - 520) / 100, 0), 1)
    + 0.15 * least(greatest((oil_temp_C - 65) / 40, 0), 1)
    + 0.10 * (days_since_maintenance / 365), 0), 1) AS risk_score FROM machines)"""
RISK_VIEWS = [B.MACHINES_SQL, RISK_SQL]


@query(
    "p24_risk",
    f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {r('risk_score')} AS risk_score FROM risk",
    RISK_VIEWS,
)
def p24_risk(spark, sf):
    return B.labelled_machines(spark, sf).select(*B.MACHINE_KEY, rd("risk_score"))


@query(
    "p25_logistic",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      {r('1 / (1 + exp(-10 * (risk_score - 0.65)))')} AS failure_prob,
      CAST(CASE WHEN 1 / (1 + exp(-10 * (risk_score - 0.65))) >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS failure
      FROM risk""",
    RISK_VIEWS,
)
def p25_logistic(spark, sf):
    chance = X.failure_probability(F.col("risk_score"))
    return B.labelled_machines(spark, sf).select(
        *B.MACHINE_KEY, rd(chance).alias("failure_prob"), "failure"
    )


@query(
    "p26_rul",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CAST(least(greatest({r('(1 - risk_score) * 365', 0)}, 0), 365) AS INTEGER) AS "RUL_days" FROM risk""",
    RISK_VIEWS,
)
def p26_rul(spark, sf):
    return B.labelled_machines(spark, sf).select(*B.MACHINE_KEY, "RUL_days")


@query(
    "p27_bucket_count",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CAST(floor(operating_hours / 2000) AS INTEGER) AS maintenance_count FROM machines""",
    [B.MACHINES_SQL],
)
def p27_bucket_count(spark, sf):
    return B.machines(spark, sf).select(
        *B.MACHINE_KEY, X.service_count(F.col("operating_hours")).alias("maintenance_count")
    )
