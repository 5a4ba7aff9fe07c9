"""Operators on skewed data, under compact plans and plans for large inputs, by brute force."""

import collections
import datetime
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from pyspark.ml import regression as R_ML

from tidemark.functions import scalars as X
from tidemark.operators import aggregates as A, clustering as K, learning as M, mining as R, ordering as O, sampling as L
from tidemark.operators import statistics as S
from tidemark.operators.skew import balanced_join, running_total


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, and a third one value."""
    rng = np.random.default_rng(7)
    rows = [
        ("hot" if i % 3 == 0 else f"k{i % 40}", i, 5.0 if i % 3 == 1 else float(rng.integers(0, 50)))
        for i in range(900)
    ]
    return rows, spark.createDataFrame(rows, "k string, i long, v double")


def by_key(rows):
    groups = collections.defaultdict(list)
    for k, i, v in rows:
        groups[k].append((i, v))
    return groups


def test_every_kth(skewed, planned):
    rows, df = skewed
    got = {(r.k, r.i) for r in O.every_kth(df, 4, ["i"], ["k"]).collect()}
    expected = {(k, i) for k, g in by_key(rows).items() for i, _ in sorted(g)[::4]}
    assert got == expected
    got = sorted(r.i for r in O.every_kth(df, 5, ["i"]).collect())
    assert got == sorted(i for _, i, _ in rows)[::5]


def test_running_total_with_missing_key(spark, planned):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 4)], "k string, o int, w long")
    got = {(r.k, r.o): r.before for r in running_total(df, ["k"], ["o"], "w").collect()}
    assert got == {(None, 1): 0, (None, 2): 2, ("a", 1): 0}


def test_quantiles(skewed, planned):
    rows, df = skewed
    got = {r.k: (r.a, r.b, r.c) for r in O.quantiles(df, ["v"], {"a": 0.01, "b": 0.5, "c": 0.99}, ["k"]).collect()}
    for k, g in by_key(rows).items():
        assert got[k] == pytest.approx(tuple(np.quantile([v for _, v in g], [0.01, 0.5, 0.99])))


def test_box_summary(skewed, planned):
    rows, df = skewed
    got = {r.k: r for r in O.box_summary(df, "v", ["k"]).collect()}
    for k, g in by_key(rows).items():
        v = np.array([x for _, x in g])
        q1, q3 = np.quantile(v, [0.25, 0.75])
        reach = 1.5 * (q3 - q1)
        inside = v[(v >= q1 - reach) & (v <= q3 + reach)]
        assert (got[k].whisker_low, got[k].whisker_high) == (min(q1, inside.min()), max(q3, inside.max()))


def test_average_rank(skewed, planned):
    rows, df = skewed
    got = {r.i: r["rank"] for r in O.average_rank(df, "v").collect()}
    values = sorted(v for _, _, v in rows)
    for _, i, v in rows:
        low = values.index(v)
        assert got[i] == low + (values.count(v) + 1) / 2


def test_spearman_paths_agree(skewed, planned):
    _, df = skewed
    data = df.withColumn("w", (F.col("i") * 17 % 31).cast("double")).withColumn("i", F.col("i").cast("double"))
    full = S.spearman(data, ["i", "v", "w"], complete=True).collect()
    pairs = S.spearman(data, ["i", "v", "w"]).collect()
    a, b = ({(r.row, r.col): r.spearman for r in x} for x in (full, pairs))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_balanced_join(spark, skewed, planned, how):
    rows, df = skewed
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3)], "k string, y int")
    got = sorted((r.k, r.i) for r in balanced_join(df, right, ["k"], how).collect())
    times = {"inner": {"hot": 2, "k1": 1}, "left": {"hot": 2}, "left_semi": {"hot": 1, "k1": 1}}[how]
    expected = [(k, i) for k, i, _ in rows for _ in range(times.get(k, 1 if how == "left" else 0))]
    assert got == sorted(expected)


def test_rows_without_a_key_survive(spark, planned):
    left = spark.range(300).selectExpr("IF(id % 3 = 0, NULL, id % 2) AS k", "id AS i")
    right = spark.createDataFrame([(0, "even"), (None, "never")], "k long, y string")
    got = dict(balanced_join(left, right, ["k"], "left").groupBy("y").count().collect())
    assert got == {"even": 100, None: 200}
    got = dict(balanced_join(left, right, ["k"], "left", null_safe=True).groupBy("y").count().collect())
    assert got == {"even": 100, "never": 100, None: 100}


@pytest.fixture
def small_partitions(spark):
    """Settings under which Spark splits partitions of test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_hot_keys_are_split(spark, tmp_path, small_partitions, hot_side):
    """A key with most rows, on either side of an inner join: no task joins all of them."""
    spark.range(200_000).selectExpr("IF(id % 10 < 8, 0, id) AS k", "uuid() AS x").repartition(8).write.parquet(f"{tmp_path}/hot")
    spark.range(20_000).selectExpr("id * 10 AS k", "uuid() AS y").write.parquet(f"{tmp_path}/even")
    hot, even = spark.read.parquet(f"{tmp_path}/hot"), spark.read.parquet(f"{tmp_path}/even")
    left, right = (hot, even) if hot_side == "left" else (even, hot)
    joined = balanced_join(left, right, ["k"])
    joined.withColumn("p", F.spark_partition_id()).write.parquet(f"{tmp_path}/joined")
    tasks = spark.read.parquet(f"{tmp_path}/joined").where("k = 0").groupBy("p").count().collect()
    assert sum(r["count"] for r in tasks) == 160_000 and len(tasks) >= 3
    assert max(r["count"] for r in tasks) < 0.5 * 160_000


def test_missing_keys_in_ranks(spark, tmp_path, planned):
    """A missing group key is a group, from stored tables and under either plan."""
    spark.range(60).selectExpr("IF(id % 3 = 0, NULL, id % 3) AS k", "double(id % 7) AS v", "double(id * 13 % 11) AS w").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    ranks = O.average_rank(df, "v", ["k"])
    assert ranks.where("rank IS NULL").count() == 0 and ranks.count() == 60
    full = {(r.k, r.row): r.spearman for r in S.spearman(df, ["v", "w"], ["k"], complete=True).collect()}
    pairs = {(r.k, r.row): r.spearman for r in S.spearman(df, ["v", "w"], ["k"]).collect()}
    assert full.keys() == pairs.keys() == {(None, "w"), (1, "w"), (2, "w")}
    assert all(abs(full[k] - pairs[k]) < 1e-12 for k in full)
    best = S.best_correlation(S.pearson(df, ["v", "w"], ["k"]), S.spearman(df, ["v", "w"], ["k"], complete=True), ["k"])
    assert best.count() == 3


def test_models_do_not_depend_on_the_plan(spark):
    """The same rows in one file and in many give the same trees."""
    rows = spark.range(3000).selectExpr("id", "double(id * 37 % 101) AS a", "double(id * 11 % 53) AS b").withColumn("y", F.col("a") * 2 + F.col("b") * F.col("b"))
    recipe = M.Model(lambda f: R_ML.RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=5, maxDepth=5, seed=1))
    found = []
    for parts in (1, 7):
        fitted = M.fit(rows.repartition(parts), recipe, ["a", "b"], "y")
        found.append({r.id: r.predicted for r in M.predict(fitted, rows).collect()})
    assert found[0] == found[1]


def test_training_tasks_grow_slowly(spark):
    """Every iteration of a fit runs all tasks: rows of a task grow before their number does."""
    rows = spark.range(10).selectExpr("double(id) AS a")
    parts = {n: M.laid_out(rows, n).rdd.getNumPartitions() for n in (10, 12_000, 3_600_000, 36_000_000, 216_000_000)}
    assert list(parts.values()) == [1, 3, 24, 24, 109]


def test_linear_models_use_few_tasks(spark, monkeypatch):
    """A pass of a linear model over some thousand rows costs no more than one task; the model is the same."""
    rows = spark.range(12_000).selectExpr("double(id % 7) AS a", "double(id % 5) AS b", "int(id % 7 + id % 3 > 4) AS y")
    laid_out, seen = M.laid_out, []
    monkeypatch.setattr(M, "laid_out", lambda *a: seen.append(laid_out(*a)) or seen[-1])

    def fitted(name):
        return M.fit(rows, M.CLASSIFIERS[name], ["a", "b"], "y").stages[-1]

    few, _ = fitted("Logistic Regression"), fitted("Decision Tree")
    monkeypatch.setattr(M, "LINEAR_CELLS", 1)
    many = fitted("Logistic Regression")
    assert [df.rdd.getNumPartitions() for df in seen] == [1, 3, 3]
    assert few.coefficients.toArray().tolist() == pytest.approx(many.coefficients.toArray().tolist(), rel=1e-6)


def test_fits_of_a_board_are_one_queue(spark, monkeypatch):
    """Fits of all rows and of the folds, slow models first; each sees its own rows."""
    rows = spark.range(60).selectExpr("double(id) AS a", "double(id % 4) AS y", "int(id % 5) AS fold")
    order = []
    monkeypatch.setattr(M, "fit", lambda df, model, *rest: order.append(model) or (model, df.agg(F.sum("a")).first()[0]))
    quick, slow = M.Model(lambda f: None), M.Model(lambda f: None, effort=1)
    whole, folds = M.fit_board(rows, {"quick": quick, "slow": slow}, ["a"], "y", parallelism=1)
    assert [m is slow for m in order] == [True] * 6 + [False] * 6
    assert whole == {"quick": (quick, 1770.0), "slow": (slow, 1770.0)}
    outside = {k: 1770.0 - sum(range(k, 60, 5)) for k in range(5)}
    assert folds == {(n, k): (m, outside[k]) for n, m in (("quick", quick), ("slow", slow)) for k in range(5)}


@pytest.mark.parametrize("share", [0.001, 0.2, 0.999])
def test_split_shares(spark, share):
    train, test = L.split_rows(spark.range(20_000), ["id"], share)
    assert abs(test.count() / 20_000 - share) < 0.01 and train.count() + test.count() == 20_000
    for wrong in (0, 1, 1.5):
        with pytest.raises(ValueError):
            L.split_rows(spark.range(1), ["id"], wrong)


def test_itemsets_have_no_size_limit(spark):
    df = spark.createDataFrame([(list("abcde"),)] * 10, "items array<string>")
    sets = R.frequent_itemsets(R.basket_counts(df), 0.5)
    assert sets.count() == R.grown_itemsets(df, "items", 0.5).count() == 31
    assert R.frequent_itemsets(R.basket_counts(df), 0.5, max_items=2).count() == 15
    assert R.association_rules(sets, 0.0, 0.0).count() == 3**5 - 2 * 2**5 + 1


def test_sample_per_group(skewed, planned):
    _, df = skewed
    once = L.sample_per_group(df, 10, ["i"], ["k"])
    counts = dict(once.groupBy("k").count().collect())
    assert counts["hot"] == 10 and max(counts.values()) == 10
    plain = L.sample_rows(df.where("k = 'hot'"), 10, ["i"])
    assert {r.i for r in plain.collect()} == {r.i for r in once.where("k = 'hot'").collect()}


def test_stratified_folds(skewed, planned):
    _, df = skewed
    sizes = L.stratified_folds(df, "k", ["i"]).groupBy("k", "fold").count().collect()
    per_key = collections.defaultdict(list)
    for r in sizes:
        per_key[r.k].append(r["count"])
    assert all(max(c) - min(c) <= 1 for c in per_key.values())


def test_split_is_a_partition(skewed):
    _, df = skewed
    train, test = L.split_rows(df, ["i"])
    assert train.count() + test.count() == 900
    assert train.join(test, "i").count() == 0


def brute_density(points, eps, least):
    near = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= least
    label = {}
    for i in range(len(points)):
        if core[i] and i not in label:
            todo, label[i] = [i], i
            while todo:
                for j in np.flatnonzero(near[todo.pop()]):
                    if core[j] and j not in label:
                        label[j] = i
                        todo.append(j)
    for i in np.flatnonzero(~core):
        around = [label[j] for j in np.flatnonzero(near[i]) if core[j]]
        if around:
            label[i] = min(around)
    return [(label.get(i), bool(core[i])) for i in range(len(points))]


def test_density_clusters(spark):
    """Dense spots, copies, border points and noise."""
    rng = np.random.default_rng(3)
    points = np.vstack(
        [rng.normal(0, 0.05, (40, 3)), rng.normal(2, 0.4, (40, 3)), np.ones((20, 3)), rng.uniform(-4, 4, (30, 3))]
    )
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, point array<double>")
    got = {r.id: (r.cluster, r.is_core) for r in K.density_clusters(df, "id", 3, 0.5, 5).collect()}
    assert [got[i] for i in range(len(points))] == brute_density(points, 0.5, 5)


def test_crowded_cells_are_shared_out(spark, monkeypatch):
    """Two rings far apart, all in few cells of the grid: clusters hang together over many tasks,
    and a task names no more pairs of boxes than it takes to hang its boxes together."""
    monkeypatch.setattr(K, "CELL_ROWS", 16)
    turn = np.linspace(0, 2 * np.pi, 80, endpoint=False)
    ring = np.column_stack([np.cos(turn), np.sin(turn), 0 * turn])
    points = np.vstack([ring, ring + [0, 0, 3], [[0, 0, 1.5]]])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, point array<double>")
    got = {r.id: (r.cluster, r.is_core) for r in K.density_clusters(df, "id", 3, 0.9, 5).collect()}
    assert [got[i] for i in range(len(points))] == brute_density(points, 0.9, 5)
    assert {c for c, _ in got.values()} == {0, 80, None}
    core = df.selectExpr("id AS site", "id AS box", "point", "point AS _proj").where("id < 80")
    pairs = 80 * 20
    assert 79 <= K._touching_boxes(core, 0.9, 3).count() < pairs


def test_distances_at_the_limit_are_exact():
    draw = np.random.default_rng(5)
    x = 1000 + draw.integers(0, 4, (60, 3)).astype(float)
    for eps in (1.0, np.sqrt(2.0), 2.0):
        close = np.concatenate([c for _, c in K._close(x, x, eps)])
        assert (close == (np.square(x[:, None] - x).sum(2) <= eps * eps)).all()


def test_pairs_are_compared_in_small_tiles():
    """Blocks of points keep a flag for each pair, never distances; tiles end within blocks."""
    draw = np.random.default_rng(6)
    x, y = draw.normal(size=(1100, 20)), draw.normal(size=(1500, 20))
    want = np.square(x[:, None] - y).sum(2) <= 30.0
    tracemalloc.start()
    got = np.vstack([close for _, close in K._close(x, y, 30.0**0.5)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == want).all() and 0 < got.sum() < got.size
    assert peak < 9e6  # 40e6 with a distance for each pair
    odd = np.array([[np.nan, 0.0], [np.inf, 0.0], [0.0, 0.0]])
    assert [close.tolist() for _, close in K._close(odd, np.zeros((1, 2)), 1.0)] == [[[False], [False], [True]]]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30) if i != 11] + [(50, 52), (52, 51)]
    got = dict(K.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(12)} == {0} and {got[i] for i in range(12, 31)} == {12}
    assert {got[i] for i in (50, 51, 52)} == {50}


def test_itemsets_and_rules(spark):
    baskets = [["a", "b", "c"]] * 5 + [["a", "b"]] * 3 + [["c"]] * 2
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    sets = R.frequent_itemsets(R.basket_counts(df), 0.3)
    got = {tuple(r["items"]): r.freq for r in sets.collect()}
    assert got == {("a",): 8, ("b",): 8, ("c",): 7, ("a", "b"): 8, ("a", "c"): 5, ("b", "c"): 5, ("a", "b", "c"): 5}
    assert got == {tuple(r["items"]): r.freq for r in R.grown_itemsets(df, "items", 0.3).collect()}
    rules = {(r.antecedents, r.consequents): r for r in R.association_rules(sets, 0.0, 0.0).collect()}
    sure = rules[("a", "b")]
    assert sure.confidence == 1.0 and sure.conviction is None
    rule = rules[("c", "a, b")]
    assert rule.confidence == pytest.approx(5 / 7) and rule.lift == pytest.approx(5 / 7 / 0.8)
    assert rule.leverage == pytest.approx(0.5 - 0.7 * 0.8)
    assert rule.conviction == pytest.approx((1 - 0.8) / (1 - 5 / 7))


def final_plan(df):
    """The plan that adaptive execution ended with, after the rows were collected."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_rows(spark, tmp_path):
    """A key with six of ten rows."""
    spark.range(200_000).selectExpr("IF(id % 10 < 6, 0, id % 1000) AS k", "double(id % 997) AS v", "uuid() AS x").repartition(8).write.parquet(f"{tmp_path}/hot")
    return spark.read.parquet(f"{tmp_path}/hot")


def test_hot_keys_are_split_before_a_sum(spark, tmp_path, hot_rows, small_partitions):
    spark.range(1000).selectExpr("id AS k", "uuid() AS y").write.parquet(f"{tmp_path}/names")
    joined = balanced_join(hot_rows, spark.read.parquet(f"{tmp_path}/names"), ["k"])
    summed = A.sum_per_key(joined.where("x <> y"), ["k"], "v", "s")
    rows, plan = final_plan(summed)
    assert "skew=true" in plan
    want = dict(hot_rows.groupBy("k").agg(F.sum("v")).collect())
    assert dict(map(tuple, rows)) == want
    items = A.sum_and_distinct(joined.where("x <> y"), ["k"], "v", "v", ("s", "n"))
    rows, plan = final_plan(items)
    assert "skew=true" in plan and {r.k: r.s for r in rows} == want and {r.k: r.n for r in rows}[0] == 997


def test_hot_groups_of_box_plots_are_split(spark, hot_rows, small_partitions):
    spark.conf.set("spark.tidemark.singleTaskRows", "-1")
    try:
        rows, plan = final_plan(O.box_summary(hot_rows, "v", ["k"]))
    finally:
        spark.conf.unset("spark.tidemark.singleTaskRows")
    assert "skew=true" in plan and sum(r.n for r in rows) == 200_000
    want = {r.k: r.m for r in hot_rows.groupBy("k").agg(F.expr("percentile(v, 0.5)").alias("m")).collect()}
    assert {r.k: r.median for r in rows} == want


def test_layouts_are_told_apart_by_their_shape(spark):
    texts = ["2024-05-06 07:08:09", "06-05-2024 07:08", "06/05/2024 07:08:09", "2024-05-06T07:08", "2024-13-06 07:08", "6/5/24", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [str(r[0]) for r in df.select(X.parse_timestamp(F.col("c"))).collect()]
    assert got == ["2024-05-06 07:08:09", "2024-05-06 07:08:00", "2024-05-06 07:08:09", "2024-05-06 07:08:00"] + ["None"] * 4
    loose = df.select(X.parse_timestamp(F.col("c"), ["d/M/yy", "yyyy-MM-dd HH:mm:ss"])).collect()
    assert str(loose[0][0]) == "2024-05-06 07:08:09" and str(loose[5][0]) == "2024-05-06 00:00:00"
    assert [r[0] for r in df.select(X.parse_timestamp(F.col("c"), ["d/M/yy"])).collect()][:5] == [None] * 5


def test_quantiles_of_large_groups(spark, planned):
    """Ties, few distinct values, and values of all sizes: only brackets are put in order."""
    df = spark.range(60_000).selectExpr(
        "id % 3 AS k", "double(id * 7919 % 60013) AS a", "double(id % 5) AS b", "IF(id % 2 = 0, 0.0, exp(double(id * 31 % 1009) / 50)) AS c"
    )
    probs = {"low": 0.0, "first": 0.01, "median": 0.5, "third": 2 / 3, "high": 1.0}
    got = {(r.k, r.column): r for r in O.quantiles(df, ["a", "b", "c"], probs, ["k"]).collect()}
    exact = df.groupBy("k").agg(*[F.expr(f"percentile({c}, array({', '.join(map(str, probs.values()))}))").alias(c) for c in "abc"])
    for r in exact.collect():
        for c in "abc":
            assert [got[r.k, c][n] for n in probs] == pytest.approx(r[c], rel=1e-12)


def test_few_groups_do_not_gather_rows_for_quantiles(spark, monkeypatch):
    """Two columns are two groups: their rows meet the brackets where they lie."""
    plans = []

    def seen(df, *args, **named):
        plans.append(df._jdf.queryExecution().toString())
        return running_total(df, *args, **named)

    monkeypatch.setattr(O, "running_total", seen)
    df = spark.range(50_000).selectExpr("double(id) AS a", "double(id % 7) AS b")
    got = {r.column: r.m for r in O.quantiles(df, ["a", "b"], {"m": 0.5}).collect()}
    assert got == {"a": 24_999.5, "b": 3.0}
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]


def test_ranked_cells_are_put_back_into_rows_by_tasks_of_few_rows(spark, planned, monkeypatch):
    """Rank correlation: the cells of a row are dealt out by its number, to tasks whose rows do not
    grow with the table; a missing group is a group."""
    monkeypatch.setattr(S, "TASK_ROWS", 50)
    cells = [(None if i % 3 == 0 else i % 3, float(i * 7 % 40), float(i * i % 23)) for i in range(600)]
    rows = spark.createDataFrame(cells, "g int, a double, b double")
    ranked = S._ranked_rows(rows, ["a", "b"], ["g"])
    found = ranked.select("g", "a", "b", F.spark_partition_id().alias("task")).collect()
    assert max(collections.Counter(r["task"] for r in found).values()) < 150

    def rank(own, v):
        return sum(o < v for o in own) + (sum(o == v for o in own) + 1) / 2

    expected = collections.Counter()
    for g in (None, 1, 2):
        a, b = zip(*[c[1:] for c in cells if c[0] == g])
        expected.update((g, rank(a, x), rank(b, y)) for x, y in zip(a, b))
    assert collections.Counter((r["g"], r["a"], r["b"]) for r in found) == expected


def test_folds_of_readings_are_worked_out_once(spark, tmp_path, monkeypatch):
    """The lines and the scores of m20_cv_auc read stored folds, not every reading's hash again."""
    from tidemark.plans.catalog import models

    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, " \
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    day = datetime.datetime(2024, 1, 1)
    lines = [(i, i % 50, i % 9, 1 + i % 7, day, float(i % 50), 900.0 * (i % 119), i % 11 / 100, i % 9 / 100) for i in range(400)]
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, fitted = [], M.linear_folds
    monkeypatch.setattr(models.M, "linear_folds", lambda df, *names: seen.append(df) or fitted(df, *names))
    assert 0 <= models.m20_cv_auc(spark, str(tmp_path)).first()["cv_auc"] <= 1
    assert "md5" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
