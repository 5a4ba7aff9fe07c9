"""The workload's tables expressed over the available star-schema tables.

No telemetry, customer or machine files exist here, so each is a projection of a
given table: derived columns are plain arithmetic, and missing or repeated cells are
created by rule. Every row of the source is used. ``*_SQL`` constants state the same
definitions for the SQL engine the queries are checked with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import scalars as X
from tidemark.plans.maintenance import with_targets
from tidemark.sources.tables import read_parquet


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


# --- telemetry --------------------------------------------------------------------

TELEMETRY_SQL = """telemetry AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS source_key,
    CAST(user_id % 2 + 1 AS INTEGER) AS plant, ts AS date_time,
    CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, event_type,
    value AS ac_power, value * (1 + CAST(event_id % 10 AS DOUBLE) / 100) AS dc_power,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS irradiation,
    20 + CAST(event_id % 13 AS DOUBLE) AS ambient_temperature,
    20 + CAST(event_id % 13 AS DOUBLE)
      + 25 * CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS module_temperature,
    value * (1 + CAST(hour(ts) AS DOUBLE)) AS daily_yield,
    CAST((hour(ts) * 60 + minute(ts)) // 15 AS INTEGER) AS time_slot
  FROM events),
daytime AS (SELECT * FROM telemetry WHERE irradiation > 0)"""


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor readings: one row per event; plant and inverter from the user."""
    k = F.get_json_object("props", "$.k").cast("double")
    ambient = 20 + (F.col("event_id") % 13).cast("double")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("source_key"),
        (F.col("user_id") % 2 + 1).cast("int").alias("plant"),
        F.col("ts").alias("date_time"),
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        "event_type",
        F.col("value").alias("ac_power"),
        (F.col("value") * (1 + (F.col("event_id") % 10).cast("double") / 100)).alias("dc_power"),
        (k / 100).alias("irradiation"),
        ambient.alias("ambient_temperature"),
        (ambient + 25 * k / 100).alias("module_temperature"),
        (F.col("value") * (1 + F.hour("ts").cast("double"))).alias("daily_yield"),
        X.quarter_hour_slot(F.col("ts")).alias("time_slot"),
    )


def daytime(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry(spark, sf).where(F.col("irradiation") > 0)


WEATHER_SQL = """weather AS (
  SELECT CASE WHEN hour = 3 THEN plant + 100 ELSE plant END AS plant, date_trunc('hour', date_time) AS date_time,
    avg(irradiation) AS irradiation_mean, avg(ambient_temperature) AS ambient_mean
  FROM telemetry GROUP BY 1, 2)"""


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly readings per plant; those of the hour 3 of every day are of plants that have no
    telemetry, so that readings of that hour meet none."""
    elsewhere = F.when(F.col("hour") == 3, F.col("plant") + 100).otherwise(F.col("plant"))
    return (
        telemetry(spark, sf)
        .groupBy(elsewhere.alias("plant"), X.hour_start(F.col("date_time")).alias("date_time"))
        .agg(
            F.avg("irradiation").alias("irradiation_mean"),
            F.avg("ambient_temperature").alias("ambient_mean"),
        )
    )


# A closed-form predictor stands in for a model where results must be reproducible in
# SQL; predictions are 0 for one reading in 97, so that the ratio's zero rule is met.
SCORED_SQL = """scored AS (
  SELECT *, ac_power AS actual,
    CASE WHEN event_id % 97 = 0 THEN 0 ELSE 5 + 60 * irradiation END AS predicted
  FROM daytime),
rated AS (
  SELECT *, actual - predicted AS error, abs(actual - predicted) AS abs_error,
    least(greatest(actual / nullif(predicted, 0), 0), 2) AS ratio_raw,
    CASE WHEN predicted <> 0 THEN least(greatest(actual / predicted, 0), 2) END AS perf_ratio
  FROM scored)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    predicted = F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(5 + 60 * F.col("irradiation"))
    return daytime(spark, sf).withColumns(
        {"actual": F.col("ac_power"), "predicted": predicted}
    )


# --- customers and transactions ---------------------------------------------------

CUSTOMERS_SQL = """people AS (
  SELECT c_custkey, 'CC' || CAST(c_nationkey % 3 + 1 AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) AS CustomerID,
    CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'n/a'
      ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 90 AS VARCHAR) END AS Age,
    'N' || CAST(c_nationkey AS VARCHAR) || ',' || c_mktsegment AS Country,
    CASE WHEN c_custkey % 3 <> 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '@home' END AS Email,
    CASE WHEN c_custkey % 5 <> 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '@work' END AS CorporateEmail,
    CAST(c_custkey % 2 AS INTEGER) AS Newsletter
  FROM customer),
system1 AS (
  SELECT c_custkey * 2 AS row_no, * FROM people WHERE c_custkey % 2 = 0
  UNION ALL
  SELECT c_custkey * 2 + 1, * REPLACE ('1' AS Age) FROM people WHERE c_custkey % 10 = 0),
system2 AS (
  SELECT c_custkey * 2 AS row_no, * FROM people WHERE c_custkey % 2 = 1
  UNION ALL
  SELECT c_custkey * 2 + 1, * REPLACE ('99' AS Age) FROM people WHERE c_custkey % 15 = 0 AND c_custkey % 2 = 1),
systems AS (SELECT * FROM system1 UNION ALL SELECT * FROM system2)"""

def people(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    balance = F.floor(F.abs("c_acctbal")).cast("long") % 90
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(
            F.lit("CC"), (F.col("c_nationkey") % 3 + 1).cast("string"), F.lit("_"), text
        ).alias("CustomerID"),
        F.when(key % 13 == 0, None).when(key % 17 == 0, "n/a").otherwise(
            balance.cast("string")
        ).alias("Age"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit(","), "c_mktsegment").alias(
            "Country"
        ),
        F.when(key % 3 != 0, F.concat(F.lit("c"), text, F.lit("@home"))).alias("Email"),
        F.when(key % 5 != 0, F.concat(F.lit("c"), text, F.lit("@work"))).alias("CorporateEmail"),
        (key % 2).cast("int").alias("Newsletter"),
    )


def _system(rows: DataFrame, repeated: Column, age: str) -> DataFrame:
    """A customer system in which some customers occur a second time with another age."""
    copies = F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    doubled = rows.withColumn("copy", F.explode(copies))
    return doubled.select(
        (F.col("c_custkey") * 2 + F.col("copy")).alias("row_no"),
        "c_custkey",
        "CustomerID",
        F.when(F.col("copy") == 1, age).otherwise(F.col("Age")).alias("Age"),
        *[c for c in rows.columns if c not in ("c_custkey", "CustomerID", "Age")],
    )


def system1(spark: SparkSession, sf: str) -> DataFrame:
    rows = people(spark, sf).where(F.col("c_custkey") % 2 == 0)
    return _system(rows, F.col("c_custkey") % 10 == 0, "1")


def system2(spark: SparkSession, sf: str) -> DataFrame:
    rows = people(spark, sf).where(F.col("c_custkey") % 2 == 1)
    return _system(rows, F.col("c_custkey") % 15 == 0, "99")


def systems(spark: SparkSession, sf: str) -> DataFrame:
    """The customers of both systems."""
    return system1(spark, sf).unionByName(system2(spark, sf))


def padded(df: DataFrame) -> DataFrame:
    """The table as a spreadsheet holds it: a leading filler column and padded names."""
    return df.select(F.lit("x").alias("Unnamed"), *[F.col(c).alias(f" {c} ") for c in df.columns])


STORES_SQL = """stores AS (
  SELECT 'Store_' || CAST(s_suppkey AS VARCHAR) AS StoreID,
    CASE WHEN s_nationkey % 2 = 0 THEN 'Online Store' ELSE 'Onsite Store' END AS StoreType
  FROM supplier),
prices AS (SELECT p_partkey AS ProductNr, p_retailprice AS Price FROM part)"""

STORE_TYPES = ("Online Store", "Onsite Store")


def stores(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("s_nationkey") % 2 == 0, STORE_TYPES[0]).otherwise(STORE_TYPES[1])
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("Store_"), F.col("s_suppkey").cast("string")).alias("StoreID"),
        kind.alias("StoreType"),
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductNr"), F.col("p_retailprice").alias("Price")
    )


TRANSACTIONS_SQL = """transactions AS (
  SELECT l_orderkey AS OrderNumber, CASE WHEN l_orderkey % 11 = 5 THEN -l_partkey ELSE l_partkey END AS ProductNr,
    l_linenumber AS LineNumber, CAST(o_custkey AS VARCHAR) AS CustomerID,
    'Store_' || CASE WHEN l_orderkey % 7 = 3 THEN 'X' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS StoreID,
    l_shipdate AS ShipDate, l_quantity AS Quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line; some orders name a store or product that is in no list."""
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("l_orderkey").alias("OrderNumber"),
        F.when(F.col("l_orderkey") % 11 == 5, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("ProductNr"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.concat(
            F.lit("Store_"),
            F.when(F.col("l_orderkey") % 7 == 3, "X").otherwise(""),
            F.col("l_suppkey").cast("string"),
        ).alias("StoreID"),
        F.col("l_shipdate").alias("ShipDate"),
        F.col("l_quantity").alias("Quantity"),
    )


# --- machines ---------------------------------------------------------------------

# The names of the sensors and of the features of the machine models.
SENSORS = (
    "temperature_C",
    "pressure_bar",
    "vibration_mms",
    "oil_temp_C",
    "efficiency_pct",
)
FEATURES = (
    "operating_hours",
    "load_pct",
    "days_since_maintenance",
    "maintenance_count",
    "temperature_C",
    "pressure_bar",
    "vibration_mms",
    "rotation_speed_rpm",
    "voltage_V",
    "current_A",
    "oil_temp_C",
    "power_output_MW",
    "efficiency_pct",
)

MACHINES_SQL = """machines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CAST(l_suppkey % 20 + 1 AS INTEGER) AS machine_no, l_shipdate AS timestamp,
    CAST(l_partkey * 37 % 8760 AS DOUBLE) AS operating_hours, 40 + l_quantity AS load_pct,
    CAST(l_orderkey % 366 AS DOUBLE) AS days_since_maintenance,
    500 + l_extendedprice / 1000 AS temperature_C,
    150 + l_quantity / 5 + CAST(l_partkey % 17 AS DOUBLE) AS pressure_bar,
    0.1 + l_discount * 100 + CAST(l_orderkey % 11 AS DOUBLE) / 10 AS vibration_mms,
    62 + l_tax * 400 + CAST(l_suppkey % 19 AS DOUBLE) AS oil_temp_C,
    97 - l_discount * 90 - CAST(l_suppkey % 13 AS DOUBLE) / 2 AS efficiency_pct
  FROM lineitem)"""


def machines(spark: SparkSession, sf: str) -> DataFrame:
    """Machine readings: one per order line."""
    part, order = F.col("l_partkey"), F.col("l_orderkey")
    hours = (part * 37 % 8760).cast("double")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        (F.col("l_suppkey") % 20 + 1).cast("int").alias("machine_no"),
        F.col("l_shipdate").alias("timestamp"),
        hours.alias("operating_hours"),
        (40 + F.col("l_quantity")).alias("load_pct"),
        (order % 366).cast("double").alias("days_since_maintenance"),
        (500 + F.col("l_extendedprice") / 1000).alias("temperature_C"),
        (150 + F.col("l_quantity") / 5 + (part % 17).cast("double")).alias("pressure_bar"),
        (0.1 + F.col("l_discount") * 100 + (order % 11).cast("double") / 10).alias("vibration_mms"),
        (62 + F.col("l_tax") * 400 + (F.col("l_suppkey") % 19).cast("double")).alias("oil_temp_C"),
        (97 - F.col("l_discount") * 90 - (F.col("l_suppkey") % 13).cast("double") / 2).alias("efficiency_pct"),
    )


MACHINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def _with_derived(readings: DataFrame, number: Column) -> DataFrame:
    """The remaining sensors, the risk score, the remaining days and the failure flag."""
    load = F.col("load_pct")
    return with_targets(
        readings.withColumns(
            {
                "rotation_speed_rpm": 1500 + F.col("pressure_bar") + (number % 41).cast("double"),
                "voltage_V": 6000 + 3 * F.col("temperature_C") + (number % 53).cast("double"),
                "current_A": 90 + F.col("oil_temp_C") / 2 + (number % 29).cast("double"),
                "power_output_MW": load * F.col("efficiency_pct") / 100,
            }
        )
    )


def labelled_machines(spark: SparkSession, sf: str) -> DataFrame:
    return _with_derived(machines(spark, sf), F.col("l_orderkey"))


def labelled_assets(spark: SparkSession, sf: str) -> DataFrame:
    """Readings averaged per part: one row per part, from all order lines."""
    measured = ("operating_hours", "load_pct", "days_since_maintenance", *SENSORS)
    means = machines(spark, sf).groupBy("l_partkey").agg(*[F.avg(c).alias(c) for c in measured])
    return _with_derived(means, F.col("l_partkey"))


# --- documents and vectors --------------------------------------------------------

DOCS_SQL = """docs AS (
  SELECT d.doc_id, n_chars, CAST(length(text) AS DOUBLE) AS length,
    CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS spaces,
    CAST(length(text) - length(translate(text, '0123456789', '')) AS DOUBLE) AS digits,
    CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS lines,
    CAST(length(text) - length(replace(text, '.', '')) AS DOUBLE) AS stops,
    lang, source, quality, toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

DOC_FEATURES = ("length", "space_share", "digit_share", "line_share", "stop_share")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with counts taken over their whole text."""
    return _counted_docs(spark, sf, "inner")


def _counted_docs(spark: SparkSession, sf: str, how: str) -> DataFrame:
    text = F.col("text")

    def count(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")

    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id", how)
        .select(
            "doc_id",
            "n_chars",
            F.length(text).cast("double").alias("length"),
            count(" ").alias("spaces"),
            count("0123456789").alias("digits"),
            count("\n").alias("lines"),
            count(".").alias("stops"),
            "lang",
            "source",
            "quality",
            "toxic",
        )
    )


def doc_features(spark: SparkSession, sf: str) -> DataFrame:
    return _shares(docs(spark, sf))


def all_doc_features(spark: SparkSession, sf: str) -> DataFrame:
    """The same for every document; the labels of most are missing."""
    rows = _counted_docs(spark, sf, "left")
    return _shares(rows.na.fill(0.0, ["length", "spaces", "digits", "lines", "stops"]))


def _shares(rows: DataFrame) -> DataFrame:
    size = F.greatest(F.col("length"), F.lit(1.0))
    shares = {"space": "spaces", "digit": "digits", "line": "lines", "stop": "stops"}
    return rows.withColumns({f"{k}_share": F.col(v) / size for k, v in shares.items()})


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("point"), "label"
    )


VECTOR_DIMS = 64
