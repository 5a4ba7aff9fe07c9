"""One test per rule on missing values, zero division, rounding, keys and ties."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import aggregates as A, cleaning as P, joins as J, monitoring as Q
from tidemark.operators import ordering as O, statistics as S
from tidemark.sources import tables

NAN = float("nan")


def one(df):
    return df.collect()[0][0]


def test_nan_is_missing(spark):
    df = P.nan_to_null(spark.createDataFrame([(NAN,), (1.0,), (-1.0,)], "v double"))
    assert df.where("v > 0").count() == 1
    assert one(df.agg(F.avg("v"))) == 0.0


def test_all_missing_group_sums_to_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    assert dict(A.sum_per_key(df, ["k"], "v", "s").collect()) == {"a": 0.0, "b": 2.0}


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (9.0,)], "v double")
    got = [r[0] for r in df.select(X.clip(F.col("v"), 0.0, 2.0)).collect()]
    assert got == [None, 0.0, 2.0]


def test_zero_denominators_give_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 4.0)], "a double, p double")
    rows = df.select(
        X.performance_ratio(F.col("a"), F.col("p")), X.percentage_error(F.col("a"), F.col("p"))
    ).collect()
    assert [tuple(r) for r in rows] == [(None, 100.0), (0.0, None)]


def test_missing_text_stays_missing(spark):
    df = spark.createDataFrame([(None,), (3,)], "Newsletter int")
    assert [r[0] for r in df.select(F.col("Newsletter").cast("string")).collect()] == [None, "3"]


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(2.5,)], "v double")
    assert one(df.select(X.rounded(F.col("v"), 0))) == 3.0
    assert one(df.select(X.rounded(F.lit(0.285), 2))) == 0.29


def test_missing_group_keys_are_dropped(spark):
    df = spark.createDataFrame([(None, 1), ("a", 1)], "k string, p int")
    assert [tuple(r) for r in A.count_per_key(df, ["k"], "p", "n").collect()] == [("a", 1)]


def test_missing_join_keys_do_not_match(spark, planned):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "id string, x int")
    right = spark.createDataFrame([(None, 3), ("a", 4)], "id string, y int")
    assert [tuple(r) for r in J.join_on_id(left, right, "id").collect()] == [("a", 2, 4)]


def test_tied_mode_is_the_smallest(spark):
    df = spark.createDataFrame([("5",), ("3",), ("5",), ("3",), ("x",)], "Age string")
    got = sorted(r[0] for r in P.impute(df, "Age", "mode").collect())
    assert got == [3.0, 3.0, 3.0, 5.0, 5.0]


@pytest.mark.parametrize("strategy, fill", [("mean", 4.0), ("median", 3.0), (7.126, 7.13)])
def test_imputation(spark, planned, strategy, fill):
    df = spark.createDataFrame([("2",), ("3",), ("7",), ("n/a",), (None,)], "Age string")
    got = sorted(r[0] for r in P.impute(df, "Age", strategy).collect())
    assert got == sorted([2.0, 3.0, 7.0, fill, fill])


def test_age_groups(spark):
    ages = [(17.9,), (18.0,), (65.0,), (65.1,), (None,)]
    df = spark.createDataFrame(ages, "a double").select(X.age_group(F.col("a")))
    assert [r[0] for r in df.collect()] == ["Adolescent", "Adult", "Adult", "Older Adult", None]


def test_ratio_is_the_mean_of_row_ratios(spark):
    df = spark.createDataFrame([("e", 1.0, 1.0), ("e", 1.0, 4.0)], "e string, actual double, predicted double")
    row = Q.entity_status(Q.score_rows(df), ["e"]).collect()[0]
    assert row.perf_ratio == 0.625 and row.status == "Under"


def test_split_once(spark):
    df = spark.createDataFrame([("CC1_7_x",), ("plain",), (None,)], "c string")
    head, tail = X.split_once(F.col("c"))
    got = [tuple(r) for r in df.select(head, tail).collect()]
    assert got == [("CC1", "7_x"), ("plain", None), (None, None)]


def test_timestamps_of_mixed_formats(spark):
    df = spark.createDataFrame([("2020-05-06 07:08:09",), ("06-05-2020 07:08",), ("?",)], "c string")
    got = [str(r[0]) for r in df.select(X.parse_timestamp(F.col("c"))).collect()]
    assert got == ["2020-05-06 07:08:09", "2020-05-06 07:08:00", "None"]


def test_repeated_lookup_key_fails(spark, planned):
    fact = spark.createDataFrame([("s1",)], "StoreID string")
    dim = spark.createDataFrame([("s1", "a"), ("s1", "b")], "StoreID string, StoreType string")
    with pytest.raises(Exception, match="not unique"):
        J.lookup(fact, dim, "StoreID", "StoreType").collect()


def test_constant_columns_have_degree_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 3.0, 5.0), (1.0, 9.0, 5.0)], "x double, y double, c double")
    rows = S.best_degree(df, [("x", "y"), ("y", "c")]).collect()
    assert [(r.best_degree, r.r2) for r in rows] == [(0, 0.0), (0, 0.0)]


def test_degrees_far_from_zero(spark):
    df = spark.range(200).select(
        (F.col("id") + 1e6).alias("x"),
        (3 * F.col("id") + 1e6).alias("line"),
        (F.pow(F.col("id") - 100.0, F.lit(2))).alias("bowl"),
    )
    rows = {r.pair: r for r in S.best_degree(df, [("x", "line"), ("x", "bowl")]).collect()}
    assert rows["x -> line"].best_degree == 1 and abs(rows["x -> line"].r2 - 1) < 1e-9
    assert rows["x -> bowl"].best_degree == 2 and abs(rows["x -> bowl"].r2 - 1) < 1e-6


def test_undefined_precision_is_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = Q.classification_metrics(df).collect()[0]
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_auc_with_ties(spark, planned):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, score double")
    assert one(Q.roc_auc(df)) == 0.625


def test_population_spread(spark):
    df = spark.createDataFrame([("m", 0, 1.0, 1.0), ("m", 0, 2.0, 4.0), ("m", 1, 1.0, 1.0), ("m", 1, 3.0, 3.0)],
                               "model string, fold int, actual double, predicted double")
    from tidemark.operators.learning import cross_validated_regression

    assert cross_validated_regression(df).collect()[0].cv_mae_std == 0.5


def test_csv_markers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x, y",1.5\nnan,NaN\nNA,\n')
    from pyspark.sql.types import StructType

    rows = tables.read_csv(spark, str(tmp_path / "t.csv"), StructType.fromDDL("a string, b double")).collect()
    assert [tuple(r) for r in rows] == [("x, y", 1.5), (None, None), (None, None)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (10.0,)], "v double")
    assert dict(A.histogram(df, "v", 10).collect()) == {1: 2, 10: 1}
    assert dict(A.histogram(df.where("v = 0"), "v", 10).collect()) == {1: 1}


def test_dedupe_keeps(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 5)], "k string, o int")
    got = {k: sorted(r.o for r in P.dedupe(df, ["k"], ["o"], k).collect()) for k in ("first", "last", "none")}
    assert got == {"first": [1, 3, 4], "last": [2, 3, 5], "none": [3]}


def test_crop(spark):
    df = spark.createDataFrame([("x", 3, "c"), ("x", 1, "a"), ("x", 2, "b")], "`f` string, ` o ` int, ` v ` string")
    out = P.crop(df, 1, 1, ["` o `"])
    assert out.columns == ["o", "v"] and sorted(r.v for r in out.collect()) == ["b", "c"]


def test_first_rows_of_order(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "o int")
    assert [r.o for r in O.top_rows(df, 2, [F.col("o")]).collect()] == [1, 2]
