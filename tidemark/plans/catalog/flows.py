"""Whole flows: what they write, read back."""

from tidemark.functions.sizing import scratch_path
from tidemark.plans import bindings as B, customers as C, telemetry as T
from tidemark.plans.catalog.base import query, r, round_all
from tidemark.plans.catalog.joining import MERGED_VIEWS
from tidemark.plans.catalog.learning import BOARD_SQL
from tidemark.sources.tables import read_csv


@query(
    "flow_customers",
    f"""SELECT CustomerID AS "CustomerID", CustomerGroup AS "CustomerGroup", AgeGroup AS "AgeGroup",
        {r('coalesce(sum(Price), 0)', 2)} AS "Sum_Price", count(DISTINCT ProductNr) AS "Unique_ProductNr"
      FROM merged GROUP BY 1, 2, 3""",
    MERGED_VIEWS,
)
def flow_customers(spark, sf):
    """The customer flow from both systems to its reports; the summary as it was written."""
    out = scratch_path(spark)
    first, second = (s(spark, sf).drop("c_custkey") for s in (B.system1, B.system2))
    reports = C.run(
        B.padded(first), second, B.stores(spark, sf), B.transactions(spark, sf), B.prices(spark, sf), out, crop_rows=0
    )
    return round_all(read_csv(spark, f"{out}/customer_summary", reports["customer_summary"].schema), 2)


@query(
    "flow_train_and_score",
    f"""SELECT plant, source_key, {r('avg(actual)')} AS actual_mean, {r('avg(predicted)')} AS predicted_mean,
      {r('avg(least(greatest(actual / nullif(predicted, 0), 0), 2))')} AS perf_ratio,
      {r('avg(abs(actual - predicted))')} AS abs_error, {r('sum(actual)')} AS total_actual,
      CASE WHEN avg(least(greatest(actual / nullif(predicted, 0), 0), 2)) < 0.85 THEN 'Under' ELSE 'Normal' END AS status
      FROM (SELECT d.*, ac_power AS actual, my + c / (s * s) * (irradiation - m) AS predicted FROM daytime d, whole) GROUP BY 1, 2""",
    [B.TELEMETRY_SQL, BOARD_SQL],
)
def flow_train_and_score(spark, sf):
    """The telemetry flow: train and save on plant 1, load, score and monitor every plant."""
    root, day = scratch_path(spark), B.daytime(spark, sf)
    T.train_models(day, ["event_id"], root, features=["irradiation"], names=["Linear Regression"])
    return round_all(T.monitor(T.score_plants(day, root, "Linear Regression")))
