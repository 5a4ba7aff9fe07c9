"""Fitted models as tables: trees walked by all rows, importances, networks passed forward."""

import time

import numpy as np
import pytest
from pyspark.ml import classification as C, regression as R
from pyspark.sql import functions as F

from tests.test_forest import NAMES, rows_of
from tidemark.operators import certificates as Z, learning as M, trees as N


def tree_of(df, build):
    return M.fit(df, M.Model(lambda f: build()), NAMES, "y")


COLUMNS = {"featuresCol": "features", "labelCol": "label", "maxBins": 32, "seed": 1}


@pytest.mark.parametrize("depth", [1, 5])
def test_walk_ends_where_the_library_predicts(spark, depth):
    df = rows_of(spark, 300)
    fitted = tree_of(df, lambda: R.DecisionTreeRegressor(**COLUMNS, maxDepth=depth))
    nodes = N.node_table(spark, fitted)
    assert nodes.count() == fitted.stages[-1].numNodes
    passed = N.walk(df, nodes, NAMES)
    ends = passed.where("leaf").join(nodes.select("tree", "node", "prediction"), ["tree", "node"])
    want = dict(M.predict(fitted, df).select("id", "predicted").collect())
    got = dict(ends.select("id", "prediction").collect())
    assert got == want and ends.count() == 300
    assert passed.where("node = 0").count() == 300


def test_audit_finds_nothing_in_a_fitted_tree_and_something_in_a_wrong_one(spark):
    df = rows_of(spark, 300)
    fitted = tree_of(df, lambda: R.DecisionTreeRegressor(**COLUMNS, maxDepth=6))
    nodes = N.node_table(spark, fitted)
    row = N.audit_summary(N.split_audit(df, nodes, NAMES, "y"), nodes).first()
    assert row.n_nodes == fitted.stages[-1].numNodes and sum(row) == row.n_nodes
    other = df.withColumn("y", F.when(F.col("id") % 3 == 0, -F.col("y")).otherwise(F.col("y")))
    row = N.audit_summary(N.split_audit(other, nodes, NAMES, "y"), nodes).first()
    assert row.n_other_mean > 0 and row.n_other_impurity > 0 and row.n_better_split > 0 and row.n_other_size == 0


@pytest.mark.parametrize("build", [lambda: R.DecisionTreeRegressor(**COLUMNS, maxDepth=4), lambda: R.RandomForestRegressor(**COLUMNS, numTrees=5)])
def test_importances_are_the_library_s(spark, build):
    df = rows_of(spark, 300)
    fitted = tree_of(df, build)
    got = dict(N.importances_of(N.node_table(spark, fitted), NAMES).collect())
    assert np.allclose([got[c] for c in NAMES], fitted.stages[-1].featureImportances.toArray(), atol=1e-9)


def test_paths(spark):
    fitted = tree_of(rows_of(spark, 300), lambda: R.DecisionTreeRegressor(**COLUMNS, maxDepth=2))
    paths = {r.path for r in N.with_paths(N.node_table(spark, fitted)).collect()}
    assert paths == {"", "L", "R", "LL", "LR", "RL", "RR"}


def test_network_scores_are_those_of_its_weights(spark):
    df = rows_of(spark, 200, 4, classify=True)
    net = lambda: C.MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=[3, 5, 4, 2], maxIter=200, seed=1)
    fitted = M.fit(df, M.Model(lambda f: net(), scaled=True), NAMES, "y")
    weights = Z.network_weights(spark, fitted)
    assert weights.count() == 4 * 5 + 6 * 4 + 5 * 2
    row = Z.network_certificate(fitted, df, "y").first()
    assert (row.n, row.n_different) == (200, 0) and row.slope < 0.05
    scored = fitted.transform(df).select(Z.vector_to_array("features").alias("x"))
    moved = weights.withColumn("weight", F.col("weight") + 0.1 * F.col("unit"))
    a, b = (Z.forward(scored, w, "x").agg(F.sum(F.get("outputs", F.lit(1)))).first()[0] for w in (weights, moved))
    assert abs(a - b) > 1e-3


def test_margin_certificate(spark):
    df = rows_of(spark, 300, 5, classify=True)
    good, bad = (M.Model(lambda f, n=n: C.LinearSVC(featuresCol="features", labelCol="label", regParam=0.1, standardization=False, maxIter=n), scaled=True) for n in (200, 1))
    own, early = (Z.margin_certificate(M.fit(df, m, NAMES, "y"), df, "y").first() for m in (good, bad))
    assert own.n == 300 and own.slope < 2e-3 < 0.02 < early.slope and 0 < own.n_inside < 300


def test_layers_are_worked_out_once(spark):
    """Five hidden layers of 24 units: worked out anew for each unit of the next layer, they would
    take millions of sums a row."""
    draw = np.random.default_rng(3)
    sizes = [3, 24, 24, 24, 24, 24, 2]
    layers = [draw.normal(size=(b, a + 1)) for a, b in zip(sizes, sizes[1:])]
    cells = [(k, u, i, float(w[u, i])) for k, w in enumerate(layers) for u in range(w.shape[0]) for i in range(w.shape[1])]
    weights = spark.createDataFrame(cells, "layer int, unit int, input int, weight double")
    x = draw.normal(size=(20, 3))
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "id int, x array<double>")
    begun = time.monotonic()
    got = {r.id: r.outputs for r in Z.forward(rows, weights, "x").collect()}
    assert time.monotonic() - begun < 60
    for i, v in enumerate(x):
        for w in layers:
            total = w @ np.append(v, 1.0)
            v = 1 / (1 + np.exp(-total))
        share = np.exp(total - total.max())
        assert got[i] == pytest.approx(share / share.sum(), rel=1e-9)
