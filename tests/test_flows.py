"""The flows end to end on small tables, and model recipes against closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.sizing import scratch_path
from tidemark.operators import joins as J, learning as M, sampling as L
from tidemark.plans import customers, eda, maintenance, telemetry
from tidemark.plans.catalog import learning as boards


@pytest.fixture(scope="module")
def readings(spark):
    """Two plants of three inverters; inverter 2 of plant 2 yields half."""
    rng = np.random.default_rng(1)
    rows = []
    for n in range(1200):
        light = float(rng.uniform(-0.2, 1.0))
        plant, inverter = n % 2 + 1, n // 2 % 3
        power = max(0.0, light) * (50 if (plant, inverter) == (2, 2) else 100) + 10 + float(rng.normal(0, 1))
        rows.append((n, plant, f"inv{inverter}", n // 2 % 40, n % 24, light, 20.0 + n % 7, 25.0 + light * 9 + n % 5, power))
    ddl = ("n long, plant int, source_key string, d int, hour int, irradiation double, "
           "ambient_temperature double, module_temperature double, ac_power double")
    return spark.createDataFrame(rows, ddl).withColumn(
        "date", F.expr("date_add(DATE'2020-05-01', d)")
    ).drop("d")


def test_customer_flow(spark, tmp_path):
    first = spark.createDataFrame(
        [("x", 0, "CC1_1", "junk", "A,B", None, "w", 1), ("x", 1, "CC1_1", "40", "A,B", None, "w", 1),
         ("x", 2, "CC1_1", "41", "A,B", "e", "w", 1), ("x", 3, "CC2_2", None, "C", "e", None, 0)],
        "`i` string, ` row_no ` int, ` CustomerID ` string, ` Age ` string, ` Country ` string, "
        "` Email ` string, ` CorporateEmail ` string, ` Newsletter ` int",
    )
    second = spark.createDataFrame([(1, "CC1_3", "10"), (2, "CC1_4", "70")], "row_no int, CustomerID string, Age string")
    stores = spark.createDataFrame([("s1", "Online Store"), ("s2", "Onsite Store")], "StoreID string, StoreType string")
    sold = spark.createDataFrame(
        [("o1", "p1", "1", "s1"), ("o1", "p2", "1", "s1"), ("o2", "p1", "3", "s2"), ("o3", "p9", "2", "s9"),
         ("o4", "p2", "4", "s2"), ("o5", "p2", "none", "s1")],
        "OrderNumber string, ProductNr string, CustomerID string, StoreID string",
    )
    prices = spark.createDataFrame([("p1", 2.5), ("p2", 4.0)], "ProductNr string, Price double")
    out = customers.run(first, second, stores, sold, prices, str(tmp_path))
    totals = dict(out["total_per_customer"].collect())
    assert totals == {"1": 6.5, "2": 0.0, "3": 2.5, "4": 4.0}
    summary = {r.CustomerID: r for r in out["customer_summary"].collect()}
    assert {k: (r.CustomerGroup, r.AgeGroup, r.Unique_ProductNr) for k, r in summary.items()} == {
        "1": ("CC1", "Adult", 2), "2": ("CC2", "Adult", 1), "3": ("CC1", "Adolescent", 1), "4": ("CC1", "Older Adult", 1)
    }
    assert sum(r.Sum_Price for r in summary.values()) == sum(totals.values())
    pivot = [tuple(r) for r in out["basket_pivot"].collect()]
    assert pivot == [(1, 0, 2), (2, 1, 0)]
    people = {r.CustomerID: r for r in out["customers"].collect()}
    assert people["1"].Email == "w" and people["1"].Country == "A B" and people["2"].Age == 40.0
    assert people["3"].Country is None
    assert out["group_counts"].collect()[0]["count"] == 3
    assert out["parallel_lines"].count() == 16
    # the summary is worked out once, not for each report
    for name in ("customer_summary", "scatter"):
        assert "Aggregate" not in out[name]._jdf.queryExecution().optimizedPlan().toString()


def test_customer_flow_leaves_no_shuffle_files(spark, tmp_path):
    """Those of one table that is written are gone before the next one is; later plans keep theirs."""
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    people = spark.range(50).selectExpr("id AS row_no", "concat('CC1_', id) AS CustomerID", "string(20 + id) AS Age")
    stores = spark.range(3).selectExpr("concat('s', id) AS StoreID", "'Online Store' AS StoreType")
    sold = spark.range(500).selectExpr("id % 90 AS OrderNumber", "id % 7 AS ProductNr", "string(id % 60) AS CustomerID", "concat('s', id % 3) AS StoreID")
    prices = spark.range(7).selectExpr("id AS ProductNr", "double(id) AS Price")
    before = shuffled()
    out = customers.run(people.where("row_no % 2 = 0"), people.where("row_no % 2 = 1"), stores, sold, prices, str(tmp_path), crop_rows=0, crop_cols=0)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    totals = out["total_per_customer"]
    assert totals.count() == 50 and totals.count() == 50 and spark.read.parquet(f"{tmp_path}/merged").count() == 420
    enriched = spark.read.option("header", True).csv(f"{tmp_path}/enriched_transactions")
    assert enriched.count() == 500 and enriched.select("Price").distinct().count() == 7


def test_train_save_score_monitor(spark, readings):
    root = scratch_path(spark)
    day = telemetry.daytime(readings, [*telemetry.FEATURES, telemetry.TARGET])
    board = telemetry.train_models(day, ["n"], root).collect()
    assert [r.r2 for r in board] == sorted((r.r2 for r in board), reverse=True)
    assert {r.model for r in board} == set(telemetry.MODELS) and board[0].cv_r2 > 0.9
    scored = telemetry.score_plants(day, root, "Linear Regression")
    rows = {(r.plant, r.source_key): r for r in telemetry.monitor(scored).collect()}
    assert len(rows) == 6
    assert [k for k, r in rows.items() if r.status == "Under"] == [(2, "inv2")]
    for r in rows.values():
        assert (r.status == "Under") == (r.perf_ratio < 0.85)
        assert abs(r.total_actual / r.actual_mean - round(r.total_actual / r.actual_mean)) < 1e-6
    check = telemetry.forecast_check(scored, 30)
    assert check["daily"].select("date").distinct().count() == 10
    hour = check["hourly"].collect()[0]
    assert hour.date_time.hour == hour.hour and hour.date_time.date() == hour.date


def test_weather_join(spark, planned):
    made = spark.createDataFrame([(1, "15-05-2020 10:15", 1.0), (2, "2020-05-15 10:15:00", 2.0), (1, "2020-05-15 10:30:00", 3.0)],
                                 "plant int, date_time string, ac_power double")
    weather = spark.createDataFrame([(1, "2020-05-15 10:15:00", "k", 20.0, 30.0, 0.5)],
                                    "plant int, date_time string, source_key string, ambient_temperature double, module_temperature double, irradiation double")
    got = {r.ac_power: r.irradiation for r in telemetry.join_plants(made, weather).collect()}
    assert got == {1.0: 0.5, 2.0: None, 3.0: None}


def test_ridge_and_line_match_closed_forms(spark, readings):
    names = ["irradiation", "module_temperature", "hour"]
    data = np.array([[float(v) for v in r] for r in readings.select(*names, "ac_power").collect()])
    x, y = data[:, :-1], data[:, -1]
    z = (x - x.mean(0)) / x.std(0)
    for name, penalty in (("Ridge Regression", 1.0), ("Linear Regression", 0.0)):
        weights = np.linalg.solve(z.T @ z + penalty * np.eye(3), z.T @ (y - y.mean()))
        fitted = M.fit(readings, M.REGRESSORS[name], names, "ac_power")
        got = [r.predicted for r in M.predict(fitted, readings).select("predicted").collect()]
        assert np.allclose(sorted(got), sorted(y.mean() + z @ weights), atol=1e-6)
        assert M.feature_names(fitted) == names


def test_line_folds_match_separate_fits(spark, readings):
    folded = readings.withColumn("fold", L.fold_of([F.col("n")]))
    got = {r.n: r.predicted for r in M.linear_folds(folded, "irradiation", "ac_power").collect()}
    rows = folded.select("n", "fold", "irradiation", "ac_power").collect()
    for k in range(5):
        rest = [(r.irradiation, r.ac_power) for r in rows if r.fold != k]
        slope, start = np.polyfit(*np.array(rest).T, 1)
        for r in rows:
            if r.fold == k:
                assert got[r.n] == pytest.approx(start + slope * r.irradiation)


def test_targets(spark):
    df = spark.createDataFrame([(8760.0, 10.0, 620.0, 105.0, 365.0), (0.0, 0.0, 500.0, 60.0, 0.0)],
                               "operating_hours double, vibration_mms double, temperature_C double, oil_temp_C double, days_since_maintenance double")
    worn, new = sorted(maintenance.with_targets(df).collect(), key=lambda r: -r.operating_hours)
    assert worn.risk_score == pytest.approx(1.0) and (worn.RUL_days, worn.failure, worn.maintenance_count) == (0, 1, 4)
    assert (new.risk_score, new.RUL_days, new.failure) == (0.0, 365, 0)


def test_pair_report(spark, readings):
    day = readings.where("irradiation > 0")
    report = eda.pair_report(day, [("irradiation", "ac_power")], ["n"], ["plant"])
    best = {r.plant: r.best_degree for r in report["trends"].collect()}
    assert best == {1: 1, 2: 1}
    assert report["curves"].count() == 600 and report["limits"].count() == 4
    ranking = eda.correlations(day, ["ac_power", "irradiation", "hour"], ["plant"])
    assert ranking.count() == 6


def test_spines(spark):
    hourly = spark.createDataFrame([(1, 5, 2.0)], "plant int, hour int, m double")
    filled = J.fill_hours(hourly, ["plant"], ["m"], hourly.select("plant"))
    assert filled.count() == 24 and filled.agg(F.sum("m")).collect()[0][0] == 2.0


def test_board_splits_read_stored_rows(spark, tmp_path):
    """Splits, folds and fits do not go over the order lines or the texts again."""
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('one two. ', int(id)) AS text", "'en' AS lang", "'web' AS source", "9 * id AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.selectExpr("doc_id", "int(doc_id % 2) AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    measures = [f"double(id) AS l_{c}" for c in ("quantity", "extendedprice", "discount", "tax")]
    lines = spark.range(80).selectExpr("id AS l_orderkey", "id % 40 AS l_partkey", "id % 9 AS l_suppkey", "1 AS l_linenumber", "DATE'2020-01-01' AS l_shipdate", *measures)
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    for split, key in ((boards.doc_split, "doc_id"), (boards.asset_split, "l_partkey")):
        train, test = split(spark, str(tmp_path))
        assert not [f for df in (train, test) for f in df.inputFiles() if str(tmp_path) in f]
        assert sorted(r[0] for df in (train, test) for r in df.select(key).collect()) == list(range(40))
