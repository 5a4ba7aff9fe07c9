"""Fitted trees as tables: nodes, the way of every row through them, and what each split gains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.functions.sizing import durable, scratch_path

#: Slack on gains, relative to the whole spread of a node.
ROUNDING = 1e-9


def node_table(spark: SparkSession, fitted: PipelineModel) -> DataFrame:
    """The nodes of a fitted tree or ensemble, one row each.

    Columns: tree, node, left, right (null in a leaf), feature (its place in the model's list),
    threshold (values up to it go left), prediction, impurity, n, gain. The model is written in
    the library's own format and its node records are read, so that the nodes of large forests
    never pass through the driver.
    """
    path = scratch_path(spark)
    fitted.stages[-1].write().overwrite().save(path)
    found = spark.read.parquet(f"{path}/data")
    if "nodeData" in found.columns:
        found = found.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        found = found.select(F.lit(0).alias("tree"), "*")
    inner = F.col("leftChild") >= 0
    return found.select(
        "tree",
        F.col("id").alias("node"),
        *[F.when(inner, F.col(f"{side}Child")).alias(side) for side in ("left", "right")],
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        "prediction",
        "impurity",
        F.col("rawCount").alias("n"),
        F.when(inner, F.col("gain")).alias("gain"),
    )


def with_paths(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``path``, the turns (L, R) from the root; one join for each level."""
    found = nodes.where("node = 0").withColumn("path", F.lit(""))
    level = found
    while True:
        turns = F.explode(F.array(F.struct(F.col("left").alias("node"), F.lit("L").alias("t")), F.struct(F.col("right").alias("node"), F.lit("R").alias("t"))))
        below = level.where("left IS NOT NULL").select("tree", "path", turns.alias("c"))
        below = durable(nodes.join(below.select("tree", "c.node", F.concat("path", "c.t").alias("path")), ["tree", "node"]))
        if below.isEmpty():
            return found
        found, level = found.unionByName(below), below


def walk(rows: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Every node that each of ``rows`` comes through, level by level.

    Appends tree, node and ``leaf`` (whether the row ends there). Each level joins the rows that
    are still on their way with the nodes; nothing is sent to all tasks unless Spark finds a
    side small.
    """
    place = nodes.select("tree", "node", "left", "right", "feature", "threshold")
    trees = nodes.agg(F.sort_array(F.collect_set("tree"))).scalar()
    moving = rows.withColumn("_x", F.array(*[F.col(c).cast("double") for c in features]))
    moving = moving.withColumn("tree", F.explode(trees)).withColumn("node", F.lit(0))
    done = None
    while True:
        at = durable(moving.join(place, ["tree", "node"]))
        leaf = F.col("left").isNull()
        level = at.select(*rows.columns, "tree", "node", leaf.alias("leaf"))
        done = level if done is None else done.unionByName(level)
        onward = at.where(~leaf)
        if onward.isEmpty():
            return done
        aside = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        moving = onward.select(*rows.columns, "_x", "tree", aside.alias("node"))


def _spread(n: Column, s: Column) -> Column:
    """The part of a sum of squares that a mean explains."""
    return s * s / F.nullif(n, F.lit(0.0))


def split_audit(rows: DataFrame, nodes: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """What the rows say about every node of fitted trees that saw each row once.

    One row for each (tree, node): n, mean and variance of the label among the rows that come
    through it, ``gain`` of the node's own split and ``best_gain`` of any split at a threshold
    that the tree uses for a feature somewhere (null in leaves). Gains are decreases of the sum
    of squares; of a label 0 or 1 that is half the decrease of the Gini impurity's sum.
    """
    y = F.col(label).cast("double")
    passed = durable(walk(rows.select(*features, y.alias("_y")), nodes, features))
    facts = passed.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"), F.var_pop("_y").alias("variance"), F.sum("_y").alias("_s")
    )
    inner = nodes.where("left IS NOT NULL")
    cuts = inner.groupBy("tree", "feature").agg(F.sort_array(F.collect_set("threshold")).alias("cuts"))
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("x")) for i, c in enumerate(features)]))
    spread_out = passed.where("NOT leaf").select("tree", "node", "_y", cells.alias("c")).select("tree", "node", "_y", "c.*")
    below = F.size(F.filter("cuts", lambda t: t < F.col("x")))
    histogram = (
        spread_out.join(cuts, ["tree", "feature"])
        .groupBy("tree", "node", "feature", "cuts", below.alias("bin"))
        .agg(F.count(F.lit(1)).cast("double").alias("hn"), F.sum("_y").alias("hs"))
    )
    upto = W.partitionBy("tree", "node", "feature").orderBy("bin")
    both = histogram.select("*", F.sum("hn").over(upto).alias("ln"), F.sum("hs").over(upto).alias("ls"))
    whole = facts.select("tree", "node", F.col("n").cast("double").alias("wn"), F.col("_s").alias("ws"))
    # a bin i holds the values between the cuts i - 1 and i; the rows up to it go left of cut i
    gained = both.join(whole, ["tree", "node"]).where(F.col("ln") < F.col("wn")).select(
        "tree",
        "node",
        "feature",
        F.get("cuts", F.col("bin")).alias("threshold"),
        (
            _spread(F.col("ln"), F.col("ls"))
            + _spread(F.col("wn") - F.col("ln"), F.col("ws") - F.col("ls"))
            - _spread(F.col("wn"), F.col("ws"))
        ).alias("gain"),
    )
    best = gained.groupBy("tree", "node").agg(F.max("gain").alias("best_gain"))
    # the node's own threshold may lie above values of the bin that ends its left side
    own = inner.select("tree", "node", F.col("feature").alias("_f"), F.col("threshold").alias("_t"))
    mine = passed.where("NOT leaf").join(own, ["tree", "node"]).withColumn("_x", F.array(*[F.col(c).cast("double") for c in features]))
    left = F.get("_x", F.col("_f")) <= F.col("_t")
    sides = mine.groupBy("tree", "node").agg(
        F.count_if(left).cast("double").alias("ln"),
        F.count_if(~left).cast("double").alias("rn"),
        F.sum(F.when(left, F.col("_y")).otherwise(0.0)).alias("ls"),
        F.sum(F.when(left, 0.0).otherwise(F.col("_y"))).alias("rs"),
    )
    own_gain = sides.select(
        "tree",
        "node",
        (
            _spread(F.col("ln"), F.col("ls")) + _spread(F.col("rn"), F.col("rs")) - _spread(F.col("ln") + F.col("rn"), F.col("ls") + F.col("rs"))
        ).alias("gain"),
    )
    return facts.drop("_s").join(own_gain, ["tree", "node"], "left").join(best, ["tree", "node"], "left")


def audit_summary(audit: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: how many nodes there are, and in how many the rows' number, mean or variance
    differs from the model's, or another split gains more than the node's own."""
    both = audit.alias("a").join(nodes.alias("m"), ["tree", "node"], "full")
    scale = F.greatest(F.abs(F.col("m.prediction")), F.sqrt("m.impurity"), F.lit(1.0))
    total = F.col("a.variance") * F.col("a.n") + F.lit(1e-12)
    same = F.coalesce(F.col("a.n") == F.col("m.n"), F.lit(False))
    return both.agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.count_if(~same).alias("n_other_size"),
        F.count_if(F.abs(F.col("a.mean") - F.col("m.prediction")) > 1e-6 * scale).alias("n_other_mean"),
        F.count_if(F.abs(F.col("a.variance") - F.col("m.impurity")) > 1e-6 * scale * scale).alias("n_other_impurity"),
        F.count_if(F.col("a.best_gain") > F.col("a.gain") + ROUNDING * total).alias("n_better_split"),
    )


def importances_of(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance): each tree's gains by feature, weighted by the rows of the node and
    brought to a sum of 1, averaged over the trees; features that no tree uses have 0."""
    names = F.array(*[F.lit(c) for c in features])
    gains = nodes.where("gain IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    share = gains.withColumn("s", F.col("g") / F.sum("g").over(W.partitionBy("tree")))
    total = share.groupBy(F.get(names, F.col("feature")).alias("feature")).agg(F.sum("s").alias("s"))
    every = nodes.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    found = every.join(total, "feature", "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    whole = total.agg(F.sum("s")).scalar()
    return found.select("feature", F.coalesce(F.col("s") / whole, F.lit(0.0)).alias("importance"))
