"""Aggregations, group-relative flags, order, samples and splits."""

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A, cleaning as P, joins as J, monitoring as Q
from tidemark.operators import ordering as O, sampling as L
from tidemark.plans import bindings as B, customers as C, telemetry as T
from tidemark.plans.catalog.base import query, r, rd, round_all
from tidemark.plans.catalog.joining import MERGED_VIEWS, merged

TELEMETRY = [B.TELEMETRY_SQL]
RATED = [B.TELEMETRY_SQL, B.SCORED_SQL]
STATUS_SQL = """entities AS (
  SELECT plant, source_key, avg(actual) AS actual_mean, avg(predicted) AS predicted_mean,
    avg(perf_ratio) AS perf_ratio, avg(abs_error) AS abs_error, sum(actual) AS total_actual,
    CASE WHEN avg(perf_ratio) < 0.85 THEN 'Under' ELSE 'Normal' END AS status
  FROM rated GROUP BY 1, 2)"""


@query(
    "a1_total",
    f"""SELECT CustomerID AS "CustomerID", {r('coalesce(sum(Price), 0)', 2)} AS "TotalPrice_per_Customer"
      FROM merged GROUP BY 1""",
    MERGED_VIEWS,
)
def a1_total(spark, sf):
    return round_all(C.total_per_customer(merged(spark, sf)), 2)


@query(
    "a2_entity",
    f"""SELECT plant, source_key, {r('avg(ac_power)')} AS ac_mean, max(ac_power) AS ac_max,
      {r('sum(ac_power)')} AS ac_total, {r('avg(dc_power)')} AS dc_mean, {r('avg(daily_yield)')} AS yield_mean
      FROM daytime GROUP BY 1, 2""",
    TELEMETRY,
)
def a2_entity(spark, sf):
    return B.daytime(spark, sf).groupBy("plant", "source_key").agg(
        rd(F.avg("ac_power")).alias("ac_mean"),
        F.max("ac_power").alias("ac_max"),
        rd(F.sum("ac_power")).alias("ac_total"),
        rd(F.avg("dc_power")).alias("dc_mean"),
        rd(F.avg("daily_yield")).alias("yield_mean"),
    )


@query(
    "a3_basket",
    """SELECT OrderNumber AS "OrderNumber", StoreType AS "StoreType", count(ProductNr) AS "BasketSize"
      FROM merged WHERE StoreType IS NOT NULL GROUP BY 1, 2""",
    MERGED_VIEWS,
)
def a3_basket(spark, sf):
    return C.basket_sizes(merged(spark, sf))


@query(
    "a4_pivot_count",
    """SELECT n AS "BasketSize", count(*) FILTER (StoreType = 'Online Store') AS "Online Store",
      count(*) FILTER (StoreType = 'Onsite Store') AS "Onsite Store"
      FROM (SELECT OrderNumber, StoreType, count(ProductNr) AS n FROM merged WHERE StoreType IS NOT NULL GROUP BY 1, 2)
      GROUP BY 1""",
    MERGED_VIEWS,
)
def a4_pivot_count(spark, sf):
    return C.basket_pivot(merged(spark, sf), B.STORE_TYPES)


@query(
    "a5_sum_distinct",
    f"""SELECT CustomerID AS "CustomerID", CustomerGroup AS "CustomerGroup", AgeGroup AS "AgeGroup",
      {r('coalesce(sum(Price), 0)', 2)} AS "Sum_Price", count(DISTINCT ProductNr) AS "Unique_ProductNr"
      FROM merged GROUP BY 1, 2, 3""",
    MERGED_VIEWS,
)
def a5_sum_distinct(spark, sf):
    return round_all(C.per_customer(merged(spark, sf)), 2)


@query(
    "a6_daily_sum",
    f"SELECT plant, date, {r('sum(dc_power)')} AS dc_total FROM telemetry GROUP BY 1, 2",
    TELEMETRY,
)
def a6_daily_sum(spark, sf):
    return round_all(A.sum_per_key(B.telemetry(spark, sf), ["plant", "date"], "dc_power", "dc_total"))


HOURLY_MEASURES = ("ac_power", "dc_power", "ambient_temperature", "module_temperature", "irradiation")


@query(
    "a7_hourly_mean",
    f"""SELECT plant, hour, {', '.join(f"{r(f'avg({c})')} AS {c}_mean" for c in HOURLY_MEASURES)}
      FROM daytime GROUP BY 1, 2""",
    TELEMETRY,
)
def a7_hourly_mean(spark, sf):
    """All hourly means from one pass."""
    return B.daytime(spark, sf).groupBy("plant", "hour").agg(
        *[rd(F.avg(c)).alias(f"{c}_mean") for c in HOURLY_MEASURES]
    )


@query(
    "a8_ts_entity",
    f"""SELECT plant, date_time, source_key, {r('avg(ac_power)')} AS ac_mean FROM daytime GROUP BY 1, 2, 3""",
    TELEMETRY,
)
def a8_ts_entity(spark, sf):
    return B.daytime(spark, sf).groupBy("plant", "date_time", "source_key").agg(
        rd(F.avg("ac_power")).alias("ac_mean")
    )


@query(
    "a9_daily_max_sum",
    f"""SELECT date, {r('max(daily_yield)')} AS daily_yield, {r('sum(irradiation)')} AS irradiation,
      count(*) AS n FROM telemetry GROUP BY 1""",
    TELEMETRY,
)
def a9_daily_max_sum(spark, sf):
    return B.telemetry(spark, sf).groupBy("date").agg(
        rd(F.max("daily_yield")).alias("daily_yield"),
        rd(F.sum("irradiation")).alias("irradiation"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "a10_pivot_mean",
    f"""SELECT plant, CAST(day(date) AS INTEGER) AS day, {', '.join(f"{r(f'coalesce(avg(dc_power) FILTER (hour = {h}), 0)')} AS h{h}" for h in range(24))}
      FROM telemetry GROUP BY 1, 2""",
    TELEMETRY,
)
def a10_pivot_mean(spark, sf):
    """Day by hour matrix of mean power."""
    rows = B.telemetry(spark, sf).withColumn("day", F.dayofmonth("date"))
    wide = A.pivot_means(rows, ["plant", "day"], "hour", range(24), "dc_power")
    return round_all(wide.toDF("plant", "day", *[f"h{h}" for h in range(24)]))


@query(
    "a11_daily_perf",
    f"""SELECT plant, date, {r('sum(actual)')} AS actual_sum, {r('sum(predicted)')} AS predicted_sum,
      {r('avg(perf_ratio)')} AS perf_ratio FROM rated GROUP BY 1, 2""",
    RATED,
)
def a11_daily_perf(spark, sf):
    return round_all(Q.daily_performance(Q.score_rows(B.scored(spark, sf)), ["plant", "date"]))


HOURLY_SQL = """held_out AS (
  SELECT * FROM scored s WHERE date IN (
    SELECT date FROM (SELECT plant, date, row_number() OVER (PARTITION BY plant ORDER BY date) AS k
      FROM (SELECT DISTINCT plant, date FROM scored)) d WHERE d.plant = s.plant AND k > 24)),
hourly AS (SELECT plant, date, hour, avg(actual) AS actual, avg(predicted) AS predicted FROM held_out GROUP BY 1, 2, 3)"""
FORECAST = [B.TELEMETRY_SQL, B.SCORED_SQL, HOURLY_SQL]
#: The telemetry spans 30 days, so the check trains on fewer than the default.
FORECAST_DAYS = 24


@query(
    "a12_date_hour",
    f"""SELECT plant, date, hour, {r('actual')} AS actual, {r('predicted')} AS predicted,
      date + hour * INTERVAL 1 HOUR AS date_time FROM hourly""",
    FORECAST,
)
def a12_date_hour(spark, sf):
    return round_all(T.forecast_check(B.scored(spark, sf), FORECAST_DAYS)["hourly"])


@query(
    "a13_daily_mape",
    f"""SELECT plant, date, {r('sum(actual)')} AS actual, {r('sum(predicted)')} AS predicted,
      {r('abs(sum(actual) - sum(predicted)) / nullif(sum(actual), 0) * 100', 2)} AS mape FROM hourly GROUP BY 1, 2""",
    FORECAST,
)
def a13_daily_mape(spark, sf):
    daily = T.forecast_check(B.scored(spark, sf), FORECAST_DAYS)["daily"]
    return daily.select("plant", "date", rd("actual"), rd("predicted"), rd("mape", 2))


@query(
    "a14_hour_error",
    f"SELECT plant, hour, {r('avg(actual - predicted)')} AS mean_error FROM hourly GROUP BY 1, 2",
    FORECAST,
)
def a14_hour_error(spark, sf):
    return round_all(T.forecast_check(B.scored(spark, sf), FORECAST_DAYS)["by_hour"])


@query("a15_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def a15_value_counts(spark, sf):
    return O.value_counts(B.table(spark, sf, "events"), ["event_type"]).orderBy(F.desc("count"), "event_type")


@query(
    "a16_profile",
    f"""SELECT count(*) AS n, min(date_time) AS first_time, max(date_time) AS last_time,
      {r('avg(ac_power)')} AS ac_mean, max(ac_power) AS ac_max FROM telemetry""",
    TELEMETRY,
)
def a16_profile(spark, sf):
    return B.telemetry(spark, sf).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date_time").alias("first_time"),
        F.max("date_time").alias("last_time"),
        rd(F.avg("ac_power")).alias("ac_mean"),
        F.max("ac_power").alias("ac_max"),
    )


@query(
    "a17_missing",
    """SELECT 'Age' AS "column", count(*) - count(Age) AS missing FROM people
      UNION ALL SELECT 'Email', count(*) - count(Email) FROM people
      UNION ALL SELECT 'CorporateEmail', count(*) - count(CorporateEmail) FROM people""",
    [B.CUSTOMERS_SQL],
)
def a17_missing(spark, sf):
    return P.missing_counts(B.people(spark, sf), ["Age", "Email", "CorporateEmail"])


@query(
    "a18_distinct",
    "SELECT count(DISTINCT source_key) AS n_entities, count(DISTINCT date) AS n_dates FROM telemetry",
    TELEMETRY,
)
def a18_distinct(spark, sf):
    return B.telemetry(spark, sf).agg(
        F.count_distinct("source_key").alias("n_entities"), F.count_distinct("date").alias("n_dates")
    )


@query(
    "a19_first_seen",
    "SELECT source_key, min(date_time) AS first_at FROM telemetry GROUP BY 1",
    TELEMETRY,
)
def a19_first_seen(spark, sf):
    return O.first_seen(B.telemetry(spark, sf), ["source_key"], "date_time").orderBy("first_at")


@query("a19_sorted_values", "SELECT DISTINCT p_type FROM part")
def a19_sorted_values(spark, sf):
    return B.table(spark, sf, "part").select("p_type").distinct().orderBy("p_type")


@query(
    "a20_under_rate",
    f"""SELECT plant, count(*) FILTER (status = 'Under') AS n_under, count(*) AS n_entities,
      {r("count(*) FILTER (status = 'Under') / count(*)")} AS under_rate, {r('avg(perf_ratio)')} AS mean_ratio,
      {r('avg(abs_error)')} AS mean_abs_error FROM entities GROUP BY 1""",
    [*RATED, STATUS_SQL],
)
def a20_under_rate(spark, sf):
    return round_all(A.under_rate(T.monitor(B.scored(spark, sf)), ["plant"]))


LIMIT_COLUMNS = ("ac_power", "irradiation", "module_temperature", "daily_yield")


@query(
    "a21_quantiles",
    " UNION ALL ".join(
        f"""SELECT plant, '{c}' AS "column", {r(f'quantile_cont({c}, 0.01)')} AS low,
        {r(f'quantile_cont({c}, 0.99)')} AS high FROM daytime GROUP BY 1"""
        for c in LIMIT_COLUMNS
    ),
    TELEMETRY,
)
def a21_quantiles(spark, sf):
    probs = {"low": 0.01, "high": 0.99}
    return round_all(O.quantiles(B.daytime(spark, sf), LIMIT_COLUMNS, probs, ["plant"]))


@query(
    "a22_group_median",
    " UNION ALL ".join(
        f"""SELECT p_brand, '{c}' AS "column", {r(f'median({c})')} AS median FROM part GROUP BY 1"""
        for c in ("p_size", "p_retailprice")
    ),
)
def a22_group_median(spark, sf):
    rows = B.table(spark, sf, "part")
    return round_all(O.quantiles(rows, ["p_size", "p_retailprice"], {"median": 0.5}, ["p_brand"]))


@query(
    "a23_box",
    f"""SELECT plant, source_key, {r('q1')} AS q1, {r('q2')} AS median, {r('q3')} AS q3,
      {r('least(q1, min(error) FILTER (error >= q1 - 1.5 * (q3 - q1) AND error <= q3 + 1.5 * (q3 - q1)))')} AS whisker_low,
      {r('greatest(q3, max(error) FILTER (error >= q1 - 1.5 * (q3 - q1) AND error <= q3 + 1.5 * (q3 - q1)))')} AS whisker_high,
      count(*) AS n
      FROM rated JOIN (SELECT plant, source_key, quantile_cont(error, 0.25) AS q1, quantile_cont(error, 0.5) AS q2,
        quantile_cont(error, 0.75) AS q3 FROM rated GROUP BY 1, 2) b USING (plant, source_key)
      GROUP BY plant, source_key, q1, q2, q3""",
    RATED,
)
def a23_box(spark, sf):
    """Error distribution of every inverter."""
    return round_all(O.box_summary(Q.score_rows(B.scored(spark, sf)), "error", ["plant", "source_key"]))


@query(
    "a24_hist",
    """SELECT CAST(least(floor((error - lo) / ((hi - lo) / 50)) + 1, 50) AS INTEGER) AS bin, count(*) AS n
      FROM rated, (SELECT min(error) AS lo, max(error) AS hi FROM rated) GROUP BY 1""",
    RATED,
)
def a24_hist(spark, sf):
    return A.histogram(Q.score_rows(B.scored(spark, sf)), "error", 50)


@query(
    "n1_flag",
    f"""SELECT plant, source_key, {r('ac_mean')} AS ac_mean, {r('ac_max')} AS ac_max, {r('ac_total')} AS ac_total,
      {r('dc_mean')} AS dc_mean, {r('yield_mean')} AS yield_mean, {r('group_mean')} AS group_mean,
      CASE WHEN ac_mean < 0.9 * group_mean THEN 'Under' ELSE 'Normal' END AS flag
      FROM (SELECT *, avg(ac_mean) OVER (PARTITION BY plant) AS group_mean FROM (
        SELECT plant, source_key, avg(ac_power) AS ac_mean, max(ac_power) AS ac_max, sum(ac_power) AS ac_total,
          avg(dc_power) AS dc_mean, avg(daily_yield) AS yield_mean FROM daytime GROUP BY 1, 2))""",
    TELEMETRY,
)
def n1_flag(spark, sf):
    """Inverter summary with the flag below 90 % of the plant's mean."""
    return round_all(T.entity_summary(B.daytime(spark, sf)))


@query(
    "n1_flag_totals",
    f"""SELECT plant, source_key, {r('ac_total')} AS ac_total, {r('group_mean')} AS group_mean,
      CASE WHEN ac_total < 0.9 * group_mean THEN 'Under' ELSE 'Normal' END AS flag
      FROM (SELECT *, avg(ac_total) OVER (PARTITION BY plant) AS group_mean FROM (
        SELECT plant, source_key, sum(ac_power) AS ac_total FROM daytime GROUP BY 1, 2))""",
    TELEMETRY,
)
def n1_flag_totals(spark, sf):
    """Inverters whose total output is below 90 % of the plant's mean total."""
    totals = A.sum_per_key(B.daytime(spark, sf), ["plant", "source_key"], "ac_power", "ac_total")
    return round_all(A.flag_below_mean(totals, "ac_total", ["plant"]))


@query(
    "n2_stride",
    """SELECT plant, source_key, event_id FROM (SELECT *, row_number() OVER
      (PARTITION BY plant, source_key ORDER BY date_time, event_id) AS k FROM daytime) WHERE k % 2 = 1""",
    TELEMETRY,
)
def n2_stride(spark, sf):
    """Every second reading of each inverter."""
    rows = B.daytime(spark, sf).select("plant", "source_key", "event_id", "date_time")
    return O.every_kth(rows, 2, ["date_time", "event_id"], ["plant", "source_key"]).drop("date_time")


@query(
    "n2_stride_global",
    """SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY date_time, event_id) AS k FROM telemetry)
      WHERE k % 4 = 1""",
    TELEMETRY,
)
def n2_stride_global(spark, sf):
    """Every fourth reading of the whole table."""
    rows = B.telemetry(spark, sf).select("event_id", "date_time")
    return O.every_kth(rows, 4, ["date_time", "event_id"]).drop("date_time")


@query(
    "n3_date_split",
    """SELECT plant, date, CASE WHEN dense_rank() OVER (PARTITION BY plant ORDER BY date) <= 24 THEN 'train' ELSE 'test' END AS part
      FROM (SELECT DISTINCT plant, date FROM daytime)""",
    TELEMETRY,
)
def n3_date_split(spark, sf):
    first, later = A.leading_dates(B.daytime(spark, sf), "date", FORECAST_DAYS, ["plant"])
    return first.withColumn("part", F.lit("train")).union(later.withColumn("part", F.lit("test")))


@query(
    "n4_best",
    f"""SELECT plant, source_key, {r('perf_ratio')} AS perf_ratio FROM entities
      ORDER BY entities.perf_ratio DESC, plant, source_key LIMIT 1""",
    [*RATED, STATUS_SQL],
)
def n4_best(spark, sf):
    best = A.best_row(T.monitor(B.scored(spark, sf)), "perf_ratio", tie=["plant", "source_key"])
    return best.select("plant", "source_key", rd("perf_ratio"))


@query(
    "l1_sort",
    f"SELECT plant, source_key, {r('perf_ratio')} AS perf_ratio, status FROM entities ORDER BY entities.perf_ratio",
    [*RATED, STATUS_SQL],
)
def l1_sort(spark, sf):
    rows = T.monitor(B.scored(spark, sf)).orderBy("perf_ratio", "plant", "source_key")
    return rows.select("plant", "source_key", rd("perf_ratio"), "status")


@query("l2_sort_abs", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey")
def l2_sort_abs(spark, sf):
    rows = B.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rows.orderBy(F.abs("c_acctbal").desc(), "c_custkey")


@query(
    "l3_head",
    f"""SELECT event_id, {r('ac_power')} AS ac_power, {r('dc_power')} AS dc_power FROM telemetry
      ORDER BY date_time, event_id LIMIT 20""",
    TELEMETRY,
)
def l3_head(spark, sf):
    """First rows of a report, in time order."""
    rows = O.top_rows(B.telemetry(spark, sf), 20, [F.col("date_time"), F.col("event_id")])
    return rows.select("event_id", rd("ac_power"), rd("dc_power"))


@query(
    "l4_first8",
    """SELECT source_key, min(date_time) AS first_at FROM telemetry GROUP BY 1 ORDER BY 2 LIMIT 8""",
    TELEMETRY,
)
def l4_first8(spark, sf):
    seen = O.first_seen(B.telemetry(spark, sf), ["source_key"], "date_time")
    return O.top_rows(seen, 8, [F.col("first_at"), F.col("source_key")])


@query(
    "l4_top8",
    f"""SELECT source_key, {r('sum(dc_power)')} AS dc_total FROM telemetry GROUP BY 1
      ORDER BY sum(dc_power) DESC LIMIT 8""",
    TELEMETRY,
)
def l4_top8(spark, sf):
    totals = A.sum_per_key(B.telemetry(spark, sf), ["source_key"], "dc_power", "dc_total")
    return round_all(O.top_rows(totals, 8, [F.desc("dc_total"), F.col("source_key")]))


def mark_sql(key: str, seed: int = 42) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|{seed}')"


@query(
    "l5_sample",
    f"SELECT event_id, ac_power, irradiation FROM daytime ORDER BY {mark_sql('event_id')}, event_id LIMIT 3000",
    TELEMETRY,
)
def l5_sample(spark, sf):
    """Sampling operator: 3,000 reproducible rows."""
    rows = B.daytime(spark, sf).select("event_id", "ac_power", "irradiation")
    return L.sample_rows(rows, 3000, ["event_id"])


@query(
    "l5_sample_per_plant",
    f"""SELECT plant, event_id FROM daytime
      QUALIFY row_number() OVER (PARTITION BY plant ORDER BY {mark_sql('event_id')}, event_id) <= 2000""",
    TELEMETRY,
)
def l5_sample_per_plant(spark, sf):
    """Sampling operator: 2,000 reproducible rows of each plant."""
    rows = B.daytime(spark, sf).select("plant", "event_id")
    return L.sample_per_group(rows, 2000, ["event_id"], ["plant"])


@query(
    "l6_split",
    """SELECT event_id, CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15) AS BIGINT) < 230584300921369408 THEN 'test' ELSE 'train' END AS part
      FROM events""",
)
def l6_split(spark, sf):
    train, test = L.split_rows(B.table(spark, sf, "events").select("event_id"), ["event_id"])
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "l7_two_tables",
    """SELECT part, count(*) AS n FROM (SELECT CASE WHEN plant = 1 THEN 'train' ELSE 'test' END AS part FROM telemetry) GROUP BY 1""",
    TELEMETRY,
)
def l7_two_tables(spark, sf):
    """Separate train and test tables, brought together under a split column."""
    rows = B.telemetry(spark, sf)
    train = rows.where(F.col("plant") == 1).withColumn("part", F.lit("train"))
    test = rows.where(F.col("plant") == 2).withColumn("part", F.lit("test"))
    return O.value_counts(J.stack_tables(train, test), ["part"], "n")


@query(
    "m20_stratified_folds",
    f"""SELECT doc_id, CAST((row_number() OVER (PARTITION BY quality ORDER BY {mark_sql('doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold
      FROM labels""",
)
def m20_stratified_folds(spark, sf):
    rows = B.table(spark, sf, "labels").select("doc_id", "quality")
    return L.stratified_folds(rows, "quality", ["doc_id"]).drop("quality")
