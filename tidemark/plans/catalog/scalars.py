"""String, date and math scalars."""

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.joins import hour_spine
from tidemark.plans import bindings as B
from tidemark.plans.catalog.base import query, r, rd
from tidemark.plans.telemetry import with_date_parts

TELEMETRY = [B.TELEMETRY_SQL]


@query("x1_replace", "SELECT c_custkey, replace(Country, ',', ' ') AS country FROM people", [B.CUSTOMERS_SQL])
def x1_replace(spark, sf):
    return B.people(spark, sf).select(
        "c_custkey", X.commas_to_spaces(F.col("Country")).alias("country")
    )


@query(
    "x2_split",
    """SELECT c_custkey, split_part(CustomerID, '_', 1) AS customer_group,
      split_part(CustomerID, '_', 2) AS customer_id FROM people""",
    [B.CUSTOMERS_SQL],
)
def x2_split(spark, sf):
    group, number = X.split_once(F.col("CustomerID"))
    return B.people(spark, sf).select(
        "c_custkey", group.alias("customer_group"), number.alias("customer_id")
    )


@query("x3_prefix", "SELECT s_suppkey, left(s_name, 10) AS label FROM supplier")
def x3_prefix(spark, sf):
    return B.table(spark, sf, "supplier").select("s_suppkey", X.prefix(F.col("s_name"), 10).alias("label"))


@query("x4_pair_label", "SELECT p_partkey, p_brand || ' -> ' || p_type AS pair FROM part")
def x4_pair_label(spark, sf):
    return B.table(spark, sf, "part").select(
        "p_partkey", X.pair_label(F.col("p_brand"), F.col("p_type")).alias("pair")
    )


@query(
    "x5_format",
    """SELECT p_brand, printf('%.2f', CAST(CAST(round(CAST(avg(p_retailprice) AS DECIMAL(30,8)), 2) AS DOUBLE) AS DOUBLE)) AS mean_price
      FROM part GROUP BY 1""",
)
def x5_format(spark, sf):
    means = B.table(spark, sf, "part").groupBy("p_brand").agg(rd(F.avg("p_retailprice"), 2).alias("m"))
    return means.select("p_brand", X.fixed_decimals(F.col("m"), 2).alias("mean_price"))


@query(
    "x6_pad",
    """SELECT event_id, printf('GEN_%04d', CAST(source_key AS BIGINT)) AS machine_id,
      printf('%02d:%02d', time_slot * 15 // 60, time_slot * 15 % 60) AS slot FROM telemetry""",
    TELEMETRY,
)
def x6_pad(spark, sf):
    return B.telemetry(spark, sf).select(
        "event_id",
        X.machine_label(F.col("source_key").cast("long")).alias("machine_id"),
        X.slot_label(F.col("time_slot")).alias("slot"),
    )


@query(
    "x7_name_text",
    "SELECT p_partkey, replace(replace(p_name, ' ', '_'), '_', ' ') AS label FROM part",
)
def x7_name_text(spark, sf):
    joined = F.translate("p_name", " ", "_")
    return B.table(spark, sf, "part").select(
        "p_partkey", X.underscores_to_spaces(joined).alias("label")
    )


@query(
    "x8_parse_mixed",
    """SELECT event_id, CASE WHEN event_id % 7 = 6 THEN NULL WHEN event_id % 7 % 2 = 0 THEN date_trunc('second', ts)
      ELSE date_trunc('minute', ts) END AS date_time,
      (SELECT count(*) FROM events WHERE event_id % 7 = 6) AS n_unparsed FROM events""",
)
def x8_parse_mixed(spark, sf):
    """Texts of six layouts in one column, and some that are no timestamp, which are counted."""
    layouts = ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "yyyy-MM-dd HH:mm",
               "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy HH:mm")
    text = F.lit("about noon")
    for i, layout in enumerate(layouts):
        text = F.when(F.col("event_id") % 7 == i, F.date_format("ts", layout)).otherwise(text)
    rows = B.table(spark, sf, "events").select("event_id", text.alias("text"))
    parsed = rows.withColumn("date_time", X.parse_timestamp(F.col("text")))
    unparsed = parsed.agg(X.unparsed_count(F.col("text"), F.col("date_time"))).scalar()
    return parsed.select("event_id", "date_time", unparsed.alias("n_unparsed"))


@query(
    "x9_parse_iso",
    "SELECT event_id, date_trunc('second', ts) AS date_time FROM events",
)
def x9_parse_iso(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return B.table(spark, sf, "events").select(
        "event_id", text.cast("timestamp_ntz").alias("date_time")
    )


@query(
    "x10_date_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
      CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(ts AS DATE) AS date FROM events""",
)
def x10_date_parts(spark, sf):
    rows = with_date_parts(B.table(spark, sf, "events"), "ts")
    return rows.select("event_id", "hour", "minute", "day", "month", "date")


@query(
    "x11_slot15",
    """SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS time_min,
      CAST((hour(ts) * 60 + minute(ts)) // 15 AS INTEGER) AS time_slot FROM events""",
)
def x11_slot15(spark, sf):
    ts = F.col("ts")
    return B.table(spark, sf, "events").select(
        "event_id", X.minute_of_day(ts).alias("time_min"), X.quarter_hour_slot(ts).alias("time_slot")
    )


@query(
    "x12_hour_ts",
    """SELECT event_id, date_trunc('hour', ts) AS from_parts, date_trunc('hour', ts) AS truncated FROM events""",
)
def x12_hour_ts(spark, sf):
    """Date plus hour, and the truncated timestamp: the same value."""
    return B.table(spark, sf, "events").select(
        "event_id",
        X.date_and_hour(F.to_date("ts"), F.hour("ts")).alias("from_parts"),
        X.hour_start(F.col("ts")).alias("truncated"),
    )


@query(
    "x13_round",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      {r('l_extendedprice * (1 - l_discount)', 2)} AS net2, {r('l_extendedprice * (1 - l_discount) / 7', 4)} AS net4
      FROM lineitem""",
)
def x13_round(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return B.table(spark, sf, "lineitem").select(
        *B.MACHINE_KEY, rd(net, 2).alias("net2"), rd(net / 7, 4).alias("net4")
    )


@query(
    "x14_clip",
    """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL
      ELSE least(greatest(c_acctbal, 0), 5000) END AS balance FROM customer""",
)
def x14_clip(spark, sf):
    balance = F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))
    return B.table(spark, sf, "customer").select(
        "c_custkey", X.clip(balance, 0.0, 5000.0).alias("balance")
    )


@query(
    "x15_math",
    f"""SELECT c_custkey, abs(c_acctbal) AS size, {r('sqrt(abs(c_acctbal))')} AS root,
      {r('exp(c_acctbal / 10000)')} AS growth FROM customer""",
)
def x15_math(spark, sf):
    c = F.col("c_acctbal")
    return B.table(spark, sf, "customer").select(
        "c_custkey",
        F.abs(c).alias("size"),
        rd(F.sqrt(F.abs(c))).alias("root"),
        rd(F.exp(c / 10000)).alias("growth"),
    )


@query(
    "x16_hour_spine",
    """SELECT s.plant, s.h AS hour_start, count(t.event_id) AS n
      FROM (SELECT plant, unnest(generate_series(date_trunc('hour', min(date_time)),
              date_trunc('hour', max(date_time)), INTERVAL 1 HOUR)) AS h FROM telemetry GROUP BY plant) s
      LEFT JOIN telemetry t ON t.plant = s.plant AND date_trunc('hour', t.date_time) = s.h
      GROUP BY 1, 2""",
    TELEMETRY,
)
def x16_hour_spine(spark, sf):
    """Every hour of each plant's span with its number of readings, also when there are none."""
    rows = B.telemetry(spark, sf)
    spine = hour_spine(rows, "date_time", ["plant"])
    counts = rows.groupBy("plant", X.hour_start(F.col("date_time")).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return spine.join(counts, ["plant", "hour_start"], "left").na.fill(0, ["n"])
