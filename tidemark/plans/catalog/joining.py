"""Lookups and joins."""

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import aggregates as A, joins as J
from tidemark.plans import bindings as B, customers as C, telemetry as T
from tidemark.plans.catalog.base import query, r, rd, round_all
from tidemark.plans.catalog.cleaning import CUSTOMER_VIEWS, customers

ENRICHED_SQL = """enriched AS (
  SELECT t.*, s.StoreType, p.Price FROM transactions t
  LEFT JOIN stores s ON t.StoreID = s.StoreID LEFT JOIN prices p ON t.ProductNr = p.ProductNr)"""
MERGED_SQL = "merged AS (SELECT c.*, e.* EXCLUDE (CustomerID) FROM customers c JOIN enriched e ON c.CustomerID = e.CustomerID)"
LOOKUP_VIEWS = [B.TRANSACTIONS_SQL, B.STORES_SQL, ENRICHED_SQL]
MERGED_VIEWS = [*CUSTOMER_VIEWS, *LOOKUP_VIEWS, MERGED_SQL]


def enriched(spark, sf):
    return C.enrich(B.transactions(spark, sf), B.stores(spark, sf), B.prices(spark, sf))


def merged(spark, sf):
    """Customers joined with their enriched transactions."""
    return C.merge(customers(spark, sf), enriched(spark, sf))


@query(
    "j1_lookup_store",
    """SELECT OrderNumber AS "OrderNumber", ProductNr AS "ProductNr", LineNumber AS "LineNumber",
      StoreID AS "StoreID", StoreType AS "StoreType" FROM enriched""",
    LOOKUP_VIEWS,
)
def j1_lookup_store(spark, sf):
    rows = J.lookup(B.transactions(spark, sf), B.stores(spark, sf), "StoreID", "StoreType")
    return rows.select("OrderNumber", "ProductNr", "LineNumber", "StoreID", "StoreType")


@query(
    "j1_lookup_price",
    """SELECT OrderNumber AS "OrderNumber", ProductNr AS "ProductNr", LineNumber AS "LineNumber",
      StoreID AS "StoreID", Price AS "Price" FROM enriched""",
    LOOKUP_VIEWS,
)
def j1_lookup_price(spark, sf):
    """The lookup key is the first candidate name both tables have (J2)."""
    fact, dim = B.transactions(spark, sf), B.prices(spark, sf)
    key = J.common_key(fact, dim, C.PRODUCT_KEYS[::-1])
    return J.lookup(fact, dim, key, "Price").select(
        "OrderNumber", "ProductNr", "LineNumber", "StoreID", "Price"
    )


@query(
    "j2_key_choice",
    """SELECT o.o_orderkey AS o_orderkey, o.o_custkey AS "ProductID", c.c_acctbal AS "Price"
      FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
)
def j2_key_choice(spark, sf):
    """The first candidate name is missing on one side, so the second one is the key."""
    fact = B.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("ProductID"))
    dim = B.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ProductID"), F.col("c_acctbal").alias("Price")
    )
    return J.lookup(fact, dim, J.common_key(fact, dim, C.PRODUCT_KEYS), "Price")


@query(
    "j3_inner",
    f"""SELECT CustomerID AS "CustomerID", CustomerGroup AS "CustomerGroup", AgeGroup AS "AgeGroup",
      {r('Age')} AS "Age", Country AS "Country", OrderNumber AS "OrderNumber", ProductNr AS "ProductNr",
      LineNumber AS "LineNumber", StoreID AS "StoreID", StoreType AS "StoreType", Price AS "Price" FROM merged""",
    MERGED_VIEWS,
)
def j3_inner(spark, sf):
    return merged(spark, sf).select(
        "CustomerID", "CustomerGroup", "AgeGroup", rd("Age"), "Country", "OrderNumber",
        "ProductNr", "LineNumber", "StoreID", "StoreType", "Price",
    )


@query(
    "j3_inner_suffixes",
    """SELECT c.c_custkey AS id, c.c_mktsegment AS note_cust, o.o_orderpriority AS note_trans, o.o_orderkey AS o_orderkey
      FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""",
)
def j3_inner_suffixes(spark, sf):
    """Names that both sides have, other than the key, get a suffix."""
    left = B.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("note")
    )
    right = B.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("note"), "o_orderkey"
    )
    return J.join_on_id(left, right, "id")


@query(
    "j4_left_time",
    f"""SELECT t.event_id, t.plant, t.ac_power, {r('w.irradiation_mean')} AS irradiation_mean,
      {r('w.ambient_mean')} AS ambient_mean
      FROM telemetry t LEFT JOIN weather w ON t.plant = w.plant AND date_trunc('hour', t.date_time) = w.date_time""",
    [B.TELEMETRY_SQL, B.WEATHER_SQL],
)
def j4_left_time(spark, sf):
    """Readings with the weather of their plant and hour; the hour 3 has none."""
    readings = B.telemetry(spark, sf).select(
        "event_id", "plant", "ac_power", X.hour_start(F.col("date_time")).alias("date_time")
    )
    joined = J.join_weather(readings, B.weather(spark, sf), ["irradiation_mean", "ambient_mean"])
    return round_all(joined.drop("date_time"))


MEASURES = ("ambient_temperature", "module_temperature", "irradiation")


@query(
    "j4_join_plants",
    f"""SELECT event_id, t.plant, date_trunc('minute', t.date_time) AS date_time, ac_power, {', '.join(f'{r("w." + m)} AS {m}' for m in MEASURES)}
      FROM telemetry t LEFT JOIN (SELECT plant, date_trunc('minute', date_time) AS at, {', '.join(f'avg({m}) AS {m}' for m in MEASURES)}
        FROM telemetry GROUP BY 1, 2) w ON t.plant = w.plant AND w.at = date_trunc('minute', t.date_time)""",
    [B.TELEMETRY_SQL],
)
def j4_join_plants(spark, sf):
    """The telemetry flow: generation and weather with times as texts of different layouts."""
    rows = B.telemetry(spark, sf)
    day_first = F.date_format("date_time", "dd-MM-yyyy HH:mm").alias("date_time")
    generation = rows.select("event_id", "plant", "ac_power", day_first)
    iso = F.date_format(F.date_trunc("minute", "date_time"), "yyyy-MM-dd HH:mm:ss").alias("date_time")
    weather = rows.groupBy("plant", iso).agg(*[F.avg(m).alias(m) for m in MEASURES])
    return round_all(T.join_plants(generation, weather))


@query(
    "j5_daily_pair",
    f"""SELECT plant, date, {r('max(daily_yield)')} AS daily_yield, {r('sum(irradiation)')} AS irradiation
      FROM telemetry GROUP BY 1, 2""",
    [B.TELEMETRY_SQL],
)
def j5_daily_pair(spark, sf):
    """Daily yield and daily irradiation side by side: one aggregate instead of a join."""
    return B.telemetry(spark, sf).groupBy("plant", "date").agg(
        rd(F.max("daily_yield")).alias("daily_yield"), rd(F.sum("irradiation")).alias("irradiation")
    )


@query(
    "j6_spine",
    f"""SELECT s.plant, CAST(s.hour AS INTEGER) AS hour, {r('coalesce(avg(t.ac_power), 0)')} AS ac_mean
      FROM (SELECT plant, unnest(range(24)) AS hour FROM (SELECT DISTINCT plant FROM telemetry UNION SELECT DISTINCT plant + 2 FROM telemetry)) s
      LEFT JOIN daytime t ON t.plant = s.plant AND t.hour = s.hour
      GROUP BY 1, 2""",
    [B.TELEMETRY_SQL],
)
def j6_spine(spark, sf):
    """Hourly means of the plants and of two more without any reading; hours without any show 0."""
    rows = B.telemetry(spark, sf)
    hourly = rows.where(F.col("irradiation") > 0).groupBy("plant", "hour").agg(F.avg("ac_power").alias("ac_mean"))
    plants = rows.select(F.explode(F.array("plant", F.col("plant") + 2)).alias("plant")).distinct()
    return round_all(J.fill_hours(hourly, ["plant"], ["ac_mean"], plants))


@query(
    "j7_semi",
    """SELECT event_id, date FROM telemetry WHERE date IN
      (SELECT date FROM telemetry GROUP BY date ORDER BY date OFFSET 24)""",
    [B.TELEMETRY_SQL],
)
def j7_semi(spark, sf):
    rows = B.telemetry(spark, sf)
    _, later = A.leading_dates(rows, "date", 24)
    return J.keep_matching(rows, later, ["date"]).select("event_id", "date")
