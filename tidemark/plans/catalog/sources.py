"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.sizing import scratch_path
from tidemark.operators import cleaning as P, learning as M
from tidemark.plans import bindings as B
from tidemark.plans.catalog.base import query, r, rd
from tidemark.plans.maintenance import EXPORTS
from tidemark.sources import models, tables as S

def _schema(ddl: str):
    return StructType.fromDDL(ddl)


@query(
    "s1_csv_scan",
    f"""SELECT event_id, date_trunc('second', date_time) AS date_time, event_type,
      CASE WHEN event_id % 7 <> 0 THEN {r('ac_power', 2)} END AS ac_power FROM telemetry""",
    [B.TELEMETRY_SQL],
)
def s1_csv_scan(spark, sf):
    """Write delimited text in which some numbers read NaN, scan it with a declared schema
    whose columns are in another order."""
    path = scratch_path(spark)
    rows = B.telemetry(spark, sf).select(
        "event_id",
        F.date_trunc("second", "date_time").cast("timestamp_ntz").alias("date_time"),
        "event_type",
        F.when(F.col("event_id") % 7 == 0, F.lit(float("nan")))
        .otherwise(F.col("ac_power"))
        .alias("ac_power"),
    )
    S.write_csv(rows, path)
    ddl = "ac_power double, event_type string, event_id long, date_time timestamp_ntz"
    return S.read_csv(spark, path, _schema(ddl)).withColumn("ac_power", rd("ac_power", 2))


@query(
    "s2_spreadsheet_landed",
    """SELECT * REPLACE (CASE WHEN Age <> 'n/a' THEN Age END AS Age) FROM systems
      WHERE row_no > (SELECT min(row_no) FROM systems)""",
    [B.CUSTOMERS_SQL],
)
def s2_spreadsheet_landed(spark, sf):
    """A sheet landed as text with a filler column, padded names and a leading filler row."""
    path = scratch_path(spark)
    sheet = B.padded(B.systems(spark, sf))
    S.write_csv(sheet, path)
    landed = S.read_csv(spark, path, sheet.schema)
    return P.crop(landed, 1, 1, ["` row_no `"])


@query(
    "s3_sql_scan",
    "SELECT * FROM transactions",
    [B.TRANSACTIONS_SQL],
)
def s3_sql_scan(spark, sf):
    return S.read_sql(spark, "SELECT * FROM {t}", {"t": B.transactions(spark, sf)})


@query(
    "s4_per_plant_files",
    f"""SELECT plant, count(*) AS n, {r('sum(ac_power)', 2)} AS ac_total, count(irradiation) AS n_light
      FROM telemetry GROUP BY plant""",
    [B.TELEMETRY_SQL],
)
def s4_per_plant_files(spark, sf):
    """One file set per plant, read in one scan with the plant taken from the path."""
    root = scratch_path(spark)
    columns = ["event_id", "source_key", "ac_power", "irradiation"]
    for plant in (1, 2):
        part = B.telemetry(spark, sf).where(F.col("plant") == plant).select(*columns)
        S.write_csv(part, f"{root}/Plant_{plant}_Generation")
    ddl = "event_id long, source_key string, ac_power double, irradiation double"
    rows = S.read_per_entity(spark, f"{root}/Plant_*_Generation", _schema(ddl))
    return rows.groupBy("plant").agg(
        F.count(F.lit(1)).alias("n"),
        rd(F.sum("ac_power"), 2).alias("ac_total"),
        F.count("irradiation").alias("n_light"),
    )


@query(
    "s5_csv_sink",
    f"SELECT c_mktsegment AS segment, count(*) AS n, {r('sum(c_acctbal)', 2)} AS total FROM customer GROUP BY 1",
)
def s5_csv_sink(spark, sf):
    """Write a result table as delimited text and read it back."""
    path = scratch_path(spark)
    result = B.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), rd(F.sum("c_acctbal"), 2).alias("total")
    )
    S.write_csv(result, path)
    return S.read_csv(spark, path, _schema("segment string, n long, total double"))


@query(
    "s6_result_table",
    f"SELECT o_orderpriority AS priority, count(*) AS n, {r('avg(o_totalprice)', 2)} AS mean_price FROM orders GROUP BY 1",
)
def s6_result_table(spark, sf):
    """Write a result table to columnar files and read it back."""
    path = scratch_path(spark)
    result = B.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), rd(F.avg("o_totalprice"), 2).alias("mean_price")
    )
    S.write_parquet(result, path)
    return S.read_parquet(spark, path)


@query(
    "s7_multi_projection",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, operating_hours, load_pct,
      days_since_maintenance FROM machines""",
    [B.MACHINES_SQL],
)
def s7_multi_projection(spark, sf):
    """Export full, supervised and unsupervised variants; return the last one."""
    rows = B.labelled_machines(spark, sf).select(
        *B.MACHINE_KEY,
        "operating_hours",
        "load_pct",
        "days_since_maintenance",
        "risk_score",
        "RUL_days",
        "failure",
    )
    paths = S.export_variants(rows, scratch_path(spark), EXPORTS)
    return P.nan_to_null(spark.read.parquet(paths["unsupervised"]))


@query(
    "s8_model_roundtrip",
    f"""SELECT event_id, {r('f.a + f.b * irradiation')} AS predicted FROM daytime,
      (SELECT regr_intercept(ac_power, irradiation) AS a, regr_slope(ac_power, irradiation) AS b
       FROM daytime WHERE plant = 1) f""",
    [B.TELEMETRY_SQL],
)
def s8_model_roundtrip(spark, sf):
    """Fit on plant 1, save, load by the same facts, score both plants."""
    root = scratch_path(spark)
    day = B.daytime(spark, sf)
    fitted = M.fit(
        day.where(F.col("plant") == 1), M.REGRESSORS["Linear Regression"], ["irradiation"], "ac_power"
    )
    models.save_model(fitted, root, "Linear Regression", "ac_power", "plant1")
    loaded = models.load_model(root, "Linear Regression", "ac_power", "plant1")
    return M.predict(loaded, day).select("event_id", rd("predicted"))
