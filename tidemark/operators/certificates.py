"""Proofs, from all rows, that a fitted model is what it should be."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: Rows whose margin is nearer to 1 than this count as being on it.
ON_MARGIN = 5e-2
#: Scores that differ by less are the same.
SAME_SCORE = 1e-9


def margin_certificate(fitted: PipelineModel, rows: DataFrame, label: str, on_margin: float = ON_MARGIN) -> DataFrame:
    """How far a fitted maximum-margin classifier is from its optimum, from all ``rows``.

    The hinge loss has no slope at a margin of 1, where each row may weigh in with any share
    of its own; so the slope in each weight is an interval, and the loss is least only if every
    interval holds zero. One row: n, n_inside (margin below 1), n_on_margin, and ``slope``, the
    largest distance of zero from an interval.
    """
    last = fitted.stages[-1]
    weights = [*map(float, last.coefficients), 0.0]  # the intercept is not penalised
    scored = fitted.transform(rows).select(
        F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("y"),
        vector_to_array("rawPrediction")[1].alias("raw"),
        F.concat(vector_to_array(last.getFeaturesCol()), F.array(F.lit(1.0))).alias("x"),
    )
    margin = F.col("y") * F.col("raw")
    inside, on = margin < 1 - on_margin, F.abs(margin - 1) <= on_margin
    pull = [-F.col("y") * F.get("x", F.lit(j)) for j in range(len(weights))]
    zero = F.lit(0.0)

    def taken(rule: Column) -> list[Column]:
        return [F.avg(rule(p)) for p in pull]

    sides = {
        "fixed": taken(lambda p: F.when(inside, p).otherwise(zero)),
        "low": taken(lambda p: F.when(on, F.least(p, zero)).otherwise(zero)),
        "high": taken(lambda p: F.when(on, F.greatest(p, zero)).otherwise(zero)),
    }
    found = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(inside).alias("n_inside"),
        F.count_if(on).alias("n_on_margin"),
        *[F.array(*values).alias(side) for side, values in sides.items()],
    )
    slopes = [F.lit(last.getRegParam() * w) + F.col("fixed")[j] for j, w in enumerate(weights)]
    away = [F.greatest(s + F.col("low")[j], -(s + F.col("high")[j]), zero) for j, s in enumerate(slopes)]
    return found.select("n", "n_inside", "n_on_margin", F.array_max(F.array(*away)).alias("slope"))


def network_weights(spark: SparkSession, fitted: PipelineModel) -> DataFrame:
    """The weights of a fitted network: layer, unit, input (from 0; the last one is the constant
    1) and weight. Their number depends on the layers alone."""
    last = fitted.stages[-1]
    flat, layers, at, rows = last.weights.toArray().tolist(), last.getLayers(), 0, []
    for layer, (size, units) in enumerate(zip(layers, layers[1:])):
        # the library stores a layer's weights input by input, then the constants
        for i in range(size + 1):
            rows += [(layer, u, i, flat[at + i * units + u]) for u in range(units)]
        at += (size + 1) * units
    return spark.createDataFrame(rows, "layer int, unit int, input int, weight double")


def forward(rows: DataFrame, weights: DataFrame, inputs: str, name: str = "outputs") -> DataFrame:
    """Append the outputs of a network, layer by layer from the table of its ``weights``: units
    of hidden layers pass their sum through the logistic function, the last layer's sums are
    brought to shares that add up to 1. ``inputs`` is an array column.

    Each layer is a scalar of the table, so rows stay where they are. A unit sees its inputs as a
    variable of a function, not as an expression: Spark puts expressions of one use together, and a
    layer would then be worked out again for every unit of the next one.
    """
    layers = weights.agg(F.max("layer")).first()[0] + 1
    out = rows.withColumn("_v", F.col(inputs))
    for layer in range(layers):
        own = weights.where(F.col("layer") == layer).groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("input", "weight"))).alias("w"))
        units = own.agg(F.transform(F.sort_array(F.collect_list(F.struct("unit", "w"))), lambda u: u["w"]["weight"]).alias("u")).scalar()

        def summed(v: Column, w: Column) -> Column:
            return F.aggregate(F.zip_with(v, w, lambda a, b: a * b), F.lit(0.0), lambda total, p: total + p)

        inputs_once = F.array(F.concat("_v", F.array(F.lit(1.0))))
        sums = F.transform(inputs_once, lambda v: F.transform("_u", lambda w: summed(v, w)))
        out = out.withColumn("_u", units).withColumn("_s", F.get(sums, F.lit(0)))
        if layer < layers - 1:
            out = out.withColumn("_v", F.transform("_s", lambda s: 1 / (1 + F.exp(-s))))
    top = F.array_max("_s")
    raised = F.transform("_s", lambda s: F.exp(s - top))
    out = out.withColumn("_e", raised)
    whole = F.aggregate("_e", F.lit(0.0), lambda total, e: total + e)
    return out.select(*rows.columns, F.transform("_e", lambda e: e / whole).alias(name), F.col("_v").alias("_last"))


def network_certificate(fitted: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """Whether a fitted network's scores are those of its weights, for all ``rows``, and how
    steep the loss still is. One row: n, n_different (scores), ``slope``: the steepest mean
    slope of the loss in a weight of the last layer."""
    weights = network_weights(rows.sparkSession, fitted)
    scored = fitted.transform(rows).select(
        F.col(label).cast("double").alias("y"),
        vector_to_array("probability")[1].alias("own"),
        vector_to_array(fitted.stages[-1].getFeaturesCol()).alias("x"),
    )
    passed = forward(scored, weights, "x")
    error = F.get("outputs", F.lit(1)) - F.col("y")
    units = fitted.stages[-1].getLayers()[-2]
    slopes = [F.abs(F.avg(error * F.get("_last", F.lit(j)))) for j in range(units)] + [F.abs(F.avg(error))]
    return passed.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(F.get("outputs", F.lit(1)) - F.col("own")) > SAME_SCORE).alias("n_different"),
        F.greatest(*slopes).alias("slope"),
    )
