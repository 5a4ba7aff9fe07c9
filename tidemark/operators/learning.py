"""Model training, scoring, cross-validation and leaderboards on MLlib."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import sqrt
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel, classification as C, regression as R
from pyspark.ml.base import Estimator
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from tidemark.functions.sizing import durable, ensure_checkpoint_dir
from tidemark.operators.forest import Forest
from tidemark.operators.monitoring import classification_metrics, regression_metrics, roc_auc

# Seed, tree counts and depths, rounds, iterations, penalties, hidden layers.
SEED = 42
TREES = 100
TREE_DEPTH = 8
#: The forests are meant to be unlimited: no tree of distinct rows needs more levels.
FOREST_DEPTH = 1 << 20
#: Cut points tried for a feature.
MAX_BINS = 32
ROUNDS, BOOST_DEPTH, BOOST_STEP = 100, 3, 0.1
LOGISTIC_ITERATIONS, MARGIN_ITERATIONS = 500, 200
NETWORK_ITERATIONS, HIDDEN_LAYERS = 300, (128, 64)
RIDGE_ALPHA = 1.0
FOLDS = 5
PARALLEL_FITS = 8
#: Rows of a training task while there are few tasks, the number that counts as few, rows of a task
#: beyond that, and the most tasks (beyond that their rows grow). An iterative fit runs all tasks
#: in every iteration, and each sends its own result and metrics to the driver.
ROWS_PER_TASK, FEW_TASKS, MOST_ROWS, MOST_TASKS = 5000, 24, 2_000_000, 10_000
#: Cells of a training task of a linear model: a pass over this many takes about as long as to
#: start a task.
LINEAR_CELLS = 1_000_000


@dataclass(frozen=True)
class TrainingFacts:
    """What an estimator's settings may depend on: rows, features, label spread."""

    rows: int
    features: int
    label_spread: float
    forest_depth: int = FOREST_DEPTH
    max_bins: int = MAX_BINS


@dataclass(frozen=True)
class Model:
    """An estimator recipe; ``scaled`` models see standardised features. An iteration of a
    ``linear`` one costs a few operations per cell. Of several fits the one of most ``effort``
    starts first."""

    build: Callable[[TrainingFacts], Estimator]
    scaled: bool = False
    linear: bool = False
    effort: int = 0


def _columns(**extra):
    return {"featuresCol": "features", "labelCol": "label", **extra}


REGRESSORS: dict[str, Model] = {
    "Linear Regression": Model(
        lambda f: R.LinearRegression(**_columns(regParam=0.0, solver="normal")), scaled=True
    ),
    # The library's penalty is relative to the label's spread and the row count.
    "Ridge Regression": Model(
        lambda f: R.LinearRegression(
            **_columns(
                regParam=RIDGE_ALPHA * f.label_spread / f.rows,
                elasticNetParam=0.0,
                standardization=False,
                solver="normal",
            )
        ),
        scaled=True,
    ),
    "Decision Tree": Model(
        lambda f: R.DecisionTreeRegressor(**_columns(maxDepth=TREE_DEPTH, maxBins=f.max_bins, seed=SEED))
    ),
    "Random Forest": Model(
        lambda f: Forest(trees=TREES, depth=f.forest_depth, bins=f.max_bins, seed=SEED, **_columns()),
        effort=1,
    ),
    "Gradient Boosting": Model(
        lambda f: R.GBTRegressor(
            **_columns(maxIter=ROUNDS, maxDepth=BOOST_DEPTH, maxBins=f.max_bins, stepSize=BOOST_STEP, seed=SEED)
        ),
        effort=2,
    ),
}

CLASSIFIERS: dict[str, Model] = {
    "Decision Tree": Model(
        lambda f: C.DecisionTreeClassifier(**_columns(maxDepth=TREE_DEPTH, maxBins=f.max_bins, seed=SEED))
    ),
    "Logistic Regression": Model(
        lambda f: C.LogisticRegression(
            **_columns(
                maxIter=LOGISTIC_ITERATIONS,
                regParam=1.0 / f.rows,
                elasticNetParam=0.0,
                standardization=False,
            )
        ),
        scaled=True,
        linear=True,
    ),
    "Linear SVC": Model(
        lambda f: C.LinearSVC(**_columns(maxIter=MARGIN_ITERATIONS, regParam=1.0 / f.rows, standardization=False)),
        scaled=True,
        linear=True,
        effort=2,
    ),
    "Random Forest": Model(
        lambda f: Forest(
            trees=TREES, depth=f.forest_depth, bins=f.max_bins, tried=-1, classify=True, seed=SEED, **_columns()
        ),
        effort=1,
    ),
    "Gradient Boosting": Model(
        lambda f: C.GBTClassifier(
            **_columns(maxIter=ROUNDS, maxDepth=BOOST_DEPTH, maxBins=f.max_bins, stepSize=BOOST_STEP, seed=SEED)
        ),
        effort=3,
    ),
    "MLP Neural Network": Model(
        lambda f: C.MultilayerPerceptronClassifier(
            **_columns(
                layers=[f.features, *HIDDEN_LAYERS, 2], maxIter=NETWORK_ITERATIONS, seed=SEED
            )
        ),
        scaled=True,
        effort=3,
    ),
}


def training_facts(train: DataFrame, features: Sequence[str], label: str) -> TrainingFacts:
    row = train.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col(label).cast("double")).alias("s")
    ).first()
    return TrainingFacts(row["n"], len(features), row["s"] or 0.0)


def scaling_stages(rows: int, features: int, source: str, target: str) -> list:
    """Standardise by the population spread (the built-in scaler uses the sample's)."""
    factor = sqrt(rows / max(rows - 1, 1))
    return [
        StandardScaler(withMean=True, withStd=True, inputCol=source, outputCol=f"{target}_sample"),
        ElementwiseProduct(
            scalingVec=Vectors.dense([factor] * features),
            inputCol=f"{target}_sample",
            outputCol=target,
        ),
    ]


def fit(
    train: DataFrame,
    model: Model,
    features: Sequence[str],
    label: str,
    facts: TrainingFacts | None = None,
) -> PipelineModel:
    """Train one model; the feature list lives in the fitted assembler stage."""
    ensure_checkpoint_dir(train.sparkSession)
    facts = facts or training_facts(train, features, label)
    first = "assembled" if model.scaled else "features"
    stages = [VectorAssembler(inputCols=list(features), outputCol=first)]
    if model.scaled:
        stages += scaling_stages(facts.rows, facts.features, first, "features")
    stages.append(model.build(facts))
    data = train.select(*features, F.col(label).cast("double").alias("label"))
    task_rows = max(ROWS_PER_TASK, LINEAR_CELLS // facts.features) if model.linear else ROWS_PER_TASK
    return Pipeline(stages=stages).fit(laid_out(data, facts.rows, task_rows))


def laid_out(data: DataFrame, rows: int, task_rows: int = ROWS_PER_TASK) -> DataFrame:
    """The rows dealt out by a hash of their cells, sorted: samples that an estimator draws by
    partition are then the same whatever the cores, files or plan the rows came from. The
    number of partitions depends on the number of rows (and ``task_rows``) alone."""
    parts = max(min(rows // task_rows + 1, FEW_TASKS), min(rows // MOST_ROWS + 1, MOST_TASKS))
    return data.repartition(parts, *data.columns).sortWithinPartitions(*data.columns)


def feature_names(fitted: PipelineModel) -> list[str]:
    return fitted.stages[0].getInputCols()


def predict(fitted: PipelineModel, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Append the prediction to the rows, dropping the working columns."""
    out = fitted.transform(df.drop("prediction"))
    return out.select(*df.columns, F.col("prediction").alias(name))


def positive_score(fitted: PipelineModel) -> Column:
    """Probability of class 1, or the raw margin for a model without probabilities."""
    last = fitted.stages[-1]
    source = "probability" if hasattr(last, "getProbabilityCol") else "rawPrediction"
    return vector_to_array(F.col(source))[1]


def classify(fitted: PipelineModel, df: DataFrame) -> DataFrame:
    """Append ``prediction`` and ``score`` to the rows."""
    out = fitted.transform(df)
    return out.select(*df.columns, "prediction", positive_score(fitted).alias("score"))


def importances(fitted: PipelineModel, df: DataFrame) -> DataFrame:
    """Feature importances of a tree model, largest first."""
    rows = zip(feature_names(fitted), fitted.stages[-1].featureImportances.toArray().tolist())
    return df.sparkSession.createDataFrame(list(rows), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def _run_all(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Run driver-side tasks concurrently; each submits its own Spark jobs."""
    bound = [inheritable_thread_target(spark)(task) for task in tasks]
    with ThreadPool(max(1, min(parallelism, len(bound)))) as pool:
        return pool.map(lambda task: task(), bound, chunksize=1)


def fit_board(
    folded: DataFrame,
    models: dict[str, Model],
    features: Sequence[str],
    label: str,
    folds: int = FOLDS,
    parallelism: int = PARALLEL_FITS,
    use: Callable[[str, int | None, PipelineModel], object] | None = None,
) -> tuple[dict, dict]:
    """Fit every model on all rows, and once per fold on all rows outside the fold. All fits are
    in one queue, those of most effort first, so that none waits for a slow one to end. With
    ``use`` the results are what it returns for a name, a fold (None: all rows) and a model; it
    is called in the queue."""
    keys = [(name, k) for name in models for k in (None, *range(folds))]
    queue = sorted(keys, key=lambda key: -models[key[0]].effort)

    def task(name: str, k: int | None) -> Callable:
        rows = folded if k is None else folded.where(F.col("fold") != k)
        if use is None:
            return lambda: fit(rows, models[name], features, label)
        return lambda: use(name, k, fit(rows, models[name], features, label))

    fitted = dict(zip(queue, _run_all(folded.sparkSession, [task(*key) for key in queue], parallelism)))
    whole = {name: fitted[name, None] for name in models}
    return whole, {(name, k): fitted[name, k] for name, k in keys if k is not None}


def scored_board(
    train: DataFrame,
    test: DataFrame,
    models: dict[str, Model],
    features: Sequence[str],
    label: str,
    score: Callable[[PipelineModel, DataFrame], DataFrame],
    parallelism: int = PARALLEL_FITS,
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """The models of all rows, their predictions of the test rows and the out-of-fold predictions of
    every model, each in one table (``model``, ``fold``, ...). A model scores its rows as soon as it
    is fitted: one that grows its trees only then does so beside the other fits."""

    def use(name: str, k: int | None, m: PipelineModel) -> tuple[PipelineModel, DataFrame]:
        rows = test if k is None else train.where(F.col("fold") == k)
        return m, score(m, rows).withColumn("model", F.lit(name))

    whole, folds = fit_board(train, models, features, label, parallelism=parallelism, use=use)
    held_out, out_of_fold = (reduce(DataFrame.unionByName, [df for _, df in d.values()]) for d in (whole, folds))
    return {name: m for name, (m, _) in whole.items()}, held_out, out_of_fold


def _stored(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str
) -> tuple[DataFrame, DataFrame]:
    """Both tables stored with the columns the models use: every fit and fold reads them again."""
    used = [*features, label]
    return durable(train.select(*used, "fold")), durable(test.select(*used))


def cross_validated_regression(scored: DataFrame) -> DataFrame:
    """Per model: mean R², mean and population spread of the absolute error over folds."""
    per_fold = regression_metrics(scored, ["model", "fold"])
    return per_fold.groupBy("model").agg(
        F.avg("r2").alias("cv_r2"),
        F.avg("mae").alias("cv_mae"),
        F.stddev_pop("mae").alias("cv_mae_std"),
    )


def cross_validated_auc(scored: DataFrame, label: str, score: str = "score") -> DataFrame:
    """Per model: mean area under the ROC curve over the folds of out-of-fold scores."""
    per_fold = roc_auc(scored, ["model", "fold"], label=label, score=score)
    return per_fold.groupBy("model").agg(F.avg("auc").alias("cv_auc"))


def regression_leaderboard(
    train: DataFrame,
    test: DataFrame,
    models: dict[str, Model],
    features: Sequence[str],
    label: str,
    parallelism: int = PARALLEL_FITS,
    whole: dict[str, PipelineModel] | None = None,
) -> DataFrame:
    """Test and cross-validation metrics per model, best R² first.

    ``train`` carries a ``fold`` column. Fits run concurrently; all metrics come from
    one aggregate over the test predictions and one over the out-of-fold predictions.
    ``whole``, if given, receives the models that the test metrics are of.
    """
    def score(m: PipelineModel, df: DataFrame) -> DataFrame:
        return predict(m, df).withColumn("actual", F.col(label).cast("double"))

    train, test = _stored(train, test, features, label)
    fitted, tested, out_of_fold = scored_board(train, test, models, features, label, score, parallelism)
    if whole is not None:
        whole |= fitted
    held_out = regression_metrics(tested, ["model"]).drop("n")
    cv = cross_validated_regression(out_of_fold)
    return held_out.join(cv, "model").orderBy(F.desc("r2"), "model")


def classification_leaderboard(
    train: DataFrame,
    test: DataFrame,
    models: dict[str, Model],
    features: Sequence[str],
    label: str,
    parallelism: int = PARALLEL_FITS,
) -> DataFrame:
    """Test metrics and cross-validated AUC per model, best AUC first."""
    def score(m: PipelineModel, df: DataFrame) -> DataFrame:
        return classify(m, df)

    train, test = _stored(train, test, features, label)
    _, tested, out_of_fold = scored_board(train, test, models, features, label, score, parallelism)
    scored = durable(tested.select("model", label, "prediction", "score"))
    metrics = classification_metrics(scored, ["model"], label=label)
    auc = roc_auc(scored, ["model"], label=label)
    cv = cross_validated_auc(out_of_fold, label)
    return metrics.join(auc, "model").join(cv, "model").orderBy(F.desc("auc"), "model")


def linear_folds(df: DataFrame, x: str, y: str, fold: str = "fold") -> DataFrame:
    """Out-of-fold predictions of a one-feature least-squares line, without a model fit.

    Power sums are additive, so the sums outside a fold are the overall sums minus the
    fold's own: one pass gives all fold lines.
    """
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.where(fx.isNotNull() & fy.isNotNull())
    parts = {"n": F.lit(1.0), "sx": fx, "sy": fy, "sxx": fx * fx, "sxy": fx * fy}
    sums = both.groupBy(fold).agg(*[F.sum(v).alias(k) for k, v in parts.items()])
    whole = sums.agg(F.struct(*[F.sum(k).alias(k) for k in parts]).alias("w")).scalar()
    out = {k: whole[k] - F.col(k) for k in parts}
    slope = (out["n"] * out["sxy"] - out["sx"] * out["sy"]) / (
        out["n"] * out["sxx"] - out["sx"] * out["sx"]
    )
    lines = sums.select(
        fold, slope.alias("_b"), ((out["sy"] - slope * out["sx"]) / out["n"]).alias("_a")
    )
    # a row for each fold: stored, its size is known, and the rows are not dealt out by few folds
    joined = both.join(durable(lines), fold)
    return joined.select(
        *df.columns, fy.alias("actual"), (F.col("_a") + F.col("_b") * fx).alias("predicted")
    )
