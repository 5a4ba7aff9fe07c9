"""Correlations, trend fits and the frames behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import pair_label
from tidemark.functions.sizing import durable
from tidemark.operators.ordering import distinct_ranks, quantiles
from tidemark.operators.skew import balanced_join, running_total

#: Rows that one task puts together from their ranked cells.
TASK_ROWS = 100_000
#: A higher polynomial degree must raise R² by more than this over the degree below.
DEGREE_GAIN = 0.05


def lower_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """(row, column) pairs below the diagonal of a matrix over ``cols``."""
    return [(b, a) for a, b in combinations(cols, 2)]


def _long(wide: DataFrame, by: Sequence[str], cells: dict[tuple[str, str], Column], name: str) -> DataFrame:
    entries = [
        F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), v.alias(name))
        for (r, c), v in cells.items()
    ]
    return wide.select(*by, F.inline(F.array(*entries)))


def pearson(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Lower triangle of the correlation matrix, each pair over its complete rows."""
    pairs = lower_pairs(cols)
    wide = df.groupBy(*by).agg(
        *[
            F.corr(F.col(r).cast("double"), F.col(c).cast("double")).alias(f"c{i}")
            for i, (r, c) in enumerate(pairs)
        ]
    )
    return _long(wide, by, {p: F.col(f"c{i}") for i, p in enumerate(pairs)}, "pearson")


def spearman(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), complete: bool = False
) -> DataFrame:
    """Lower triangle of the rank correlation matrix, each pair over its complete rows.

    With ``complete`` the caller states that no cell is missing; each column is then
    ranked once. Otherwise every pair is ranked on its own complete rows.
    """
    by = list(by)
    if complete:
        ranked = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
        ranks = _ranked_rows(ranked, cols, by)
        return pearson(ranks, cols, by).withColumnRenamed("pearson", "spearman")
    entries = [
        F.struct(
            F.lit(r).alias("row"),
            F.lit(c).alias("col"),
            F.col(r).cast("double").alias("x"),
            F.col(c).cast("double").alias("y"),
        )
        for r, c in lower_pairs(cols)
    ]
    group = [*by, "row", "col"]
    long = (
        df.select(*by, F.inline(F.array(*entries)))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy(*group, "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = _weighted_rank(_weighted_rank(long, "x", group), "y", group)
    rx, ry, n = F.col("_rx"), F.col("_ry"), F.col("n")
    sums = ranked.groupBy(*group).agg(
        F.sum(n).alias("n"),
        F.sum(n * rx).alias("sx"),
        F.sum(n * ry).alias("sy"),
        F.sum(n * rx * rx).alias("sxx"),
        F.sum(n * ry * ry).alias("syy"),
        F.sum(n * rx * ry).alias("sxy"),
    )
    spread_x = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    spread_y = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    shared = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    root = F.sqrt(spread_x * spread_y)
    return sums.select(*group, (shared / F.nullif(root, F.lit(0.0))).alias("spearman"))


def _ranked_rows(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Every cell replaced by its mean rank in its column.

    All columns are ranked together as (row, column, value) cells, with one join, and
    put back into rows by the row number of the stored table. A row's cells come from as many
    tasks, where they have nothing to add up: they are dealt out first, to tasks of so many
    rows, and then put together.
    """
    stored = durable(df.withColumn("_row", F.monotonically_increasing_id()))
    cells = [F.struct(F.lit(i).alias("column"), F.col(c).alias("value")) for i, c in enumerate(cols)]
    long = stored.select("_row", *by, F.inline(F.array(*cells)))
    # one struct, which is never missing, is all that the rows of the join carry beside their number
    key = F.struct(*by, "column", "value").alias("_key")
    ranks = distinct_ranks(long, "value", [*by, "column"]).select(key, "rank")
    # a left join, so that the cells are never sent whole: a plan's estimate leaves out their number
    placed = balanced_join(long.select("_row", key), ranks, ["_key"], "left").select("_row", "_key.*", "rank")
    dealt = placed.drop("value").repartition(stored.count() // TASK_ROWS + 1, "_row")
    return dealt.groupBy("_row", *by).agg(
        *[F.max(F.when(F.col("column") == i, F.col("rank"))).alias(c) for i, c in enumerate(cols)]
    )


def _weighted_rank(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean rank of ``value`` where each row stands for ``n`` equal ones."""
    counts = df.groupBy(*by, value).agg(F.sum("n").alias("_n"))
    below = running_total(counts, by, [value], "_n", "_below")
    ranks = below.select(
        *by, value, (F.col("_below") + (F.col("_n") + 1) / F.lit(2.0)).alias(f"_r{value}")
    )
    return balanced_join(df, ranks, [*by, value], null_safe=True)


def best_correlation(pearsons: DataFrame, spearmans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per cell the rank correlation (``S``) where its size is strictly larger, else ``P``.

    Groups with a missing key are kept.
    """
    keys = [*by, "row", "col"]
    rank_wins = F.coalesce(F.abs("spearman") > F.abs("pearson"), F.lit(False))
    return balanced_join(pearsons, spearmans, keys, null_safe=True).select(
        *keys,
        F.when(rank_wins, F.col("spearman")).otherwise(F.col("pearson")).alias("corr"),
        F.when(rank_wins, "S").otherwise("P").alias("method"),
    )


def feature_ranking(best: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Features by the size of their best correlation with ``target``, largest first."""
    is_row = F.col("row") == target
    mine = best.where(is_row | (F.col("col") == target))
    feature = F.when(is_row, F.col("col")).otherwise(F.col("row"))
    return mine.select(
        *by, feature.alias("feature"), F.col("corr").alias("correlation"), "method"
    ).orderBy(*by, F.abs("correlation").desc(), "feature")


def linear_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` with the range of ``x``."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return both.groupBy(*by).agg(
        F.regr_slope(fy, fx).alias("slope"),
        F.regr_intercept(fy, fx).alias("intercept"),
        F.regr_r2(fy, fx).alias("r2"),
        F.min(fx).alias("x_min"),
        F.max(fx).alias("x_max"),
    )


def trend_line(trend: DataFrame, points: int = 100, by: Sequence[str] = ()) -> DataFrame:
    """The fitted line on an even grid; every trend row yields ``points`` rows."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    grid = trend.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("x_min") + F.col("point") * step
    return grid.select(
        *by, "point", x.alias("x"), (F.col("intercept") + F.col("slope") * x).alias("y")
    )


def best_degree(
    df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """Polynomial degree 0-2 and its R² for every (x, y) pair, with the fitted curve.

    A degree is taken when its R² exceeds that of the degree directly below by more
    than ``DEGREE_GAIN``; degree 0 is the mean with R² 0. One grouped pass serves all
    pairs: the central moments it returns are all the normal equations need. Values are
    first shifted by the mean of all rows, which keeps the moments accurate when a
    column lies far from zero; the fit itself does not depend on the shift.
    """
    by = list(by)
    used = sorted({c for pair in pairs for c in pair})
    numeric = df.select(*by, *[F.col(c).cast("double").alias(c) for c in used])
    origin = numeric.select(*used).agg(
        F.struct(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in used]).alias("o")
    ).scalar()
    entries = [
        F.struct(
            F.lit(x).alias("x_name"),
            F.lit(y).alias("y_name"),
            F.col(x).alias("x"),
            (F.col(x) - origin[x]).alias("u"),
            (F.col(y) - origin[y]).alias("v"),
            origin[x].alias("x0"),
            origin[y].alias("y0"),
        )
        for x, y in pairs
    ]
    group = [*by, "x_name", "y_name"]
    zero = F.lit(0.0)
    moments = (
        numeric.select(*by, F.inline(F.array(*entries)))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull())
        .groupBy(*group)
        .agg(
            F.min("x").alias("x_min"),
            F.max("x").alias("x_max"),
            F.max("x0").alias("x0"),
            F.max("y0").alias("y0"),
            F.avg("u").alias("mu"),
            F.avg("v").alias("mv"),
            F.stddev_pop("u").alias("su"),
            F.var_pop("v").alias("vv"),
            F.coalesce(F.skewness("u"), zero).alias("m3"),
            F.coalesce(F.kurtosis("u"), zero).alias("excess"),
            F.covar_pop("u", "v").alias("cuv"),
            F.covar_pop(F.col("u") * F.col("u"), F.col("v")).alias("cuuv"),
        )
    )
    # z = (u - mu) / su has mean 0 and mean square 1, so the linear part of the fit is
    # c1·z, and the quadratic part the projection on q = z² - 1 - m3·z, whose mean
    # square is (excess + 3) - 1 - m3².
    spread = F.nullif(F.col("su"), zero)
    scaled = moments.withColumns(
        {
            "c1": F.coalesce(F.col("cuv") / spread, zero),
            "c2": F.coalesce(
                (F.col("cuuv") - 2 * F.col("mu") * F.col("cuv")) / (spread * spread), zero
            ),
            "q2": F.col("excess") + 2 - F.col("m3") * F.col("m3"),
        }
    ).withColumn(
        "bq",
        F.coalesce(
            F.when(F.col("q2") > 1e-9, (F.col("c2") - F.col("m3") * F.col("c1")) / F.col("q2")),
            zero,
        ),
    )
    variance = F.nullif(F.col("vv"), zero)
    gains = scaled.withColumns(
        {
            "r1": F.coalesce(F.col("c1") * F.col("c1") / variance, zero),
            "gain2": F.coalesce(F.col("bq") * F.col("bq") * F.col("q2") / variance, zero),
        }
    ).withColumn(
        "best_degree",
        F.when(F.col("gain2") > DEGREE_GAIN, 2).when(F.col("r1") > DEGREE_GAIN, 1).otherwise(0),
    )
    quadratic = F.when(F.col("best_degree") == 2, F.col("bq")).otherwise(0.0)
    linear = F.when(F.col("best_degree") >= 1, F.col("c1")).otherwise(0.0)
    return gains.select(
        *by,
        pair_label(F.col("x_name"), F.col("y_name")).alias("pair"),
        "x_name",
        "y_name",
        "best_degree",
        F.when(F.col("best_degree") == 2, F.col("r1") + F.col("gain2"))
        .when(F.col("best_degree") == 1, F.col("r1"))
        .otherwise(0.0)
        .alias("r2"),
        (F.col("mu") + F.col("x0")).alias("x_mean"),
        F.col("su").alias("x_spread"),
        (F.col("mv") + F.col("y0") - quadratic).alias("b0"),
        (linear - quadratic * F.col("m3")).alias("b1"),
        quadratic.alias("b2"),
        "x_min",
        "x_max",
    )


def degree_curve(fits: DataFrame, points: int = 300, by: Sequence[str] = ()) -> DataFrame:
    """The chosen curve of every pair on an even grid between the x extremes."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    grid = fits.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("x_min") + F.col("point") * step
    z = F.coalesce((x - F.col("x_mean")) / F.nullif(F.col("x_spread"), F.lit(0.0)), F.lit(0.0))
    return grid.select(
        *by,
        "pair",
        "point",
        x.alias("x"),
        (F.col("b0") + F.col("b1") * z + F.col("b2") * z * z).alias("y"),
    )


def axis_limits(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """1 % and 99 % quantiles per column."""
    return quantiles(df, cols, {"low": 0.01, "high": 0.99}, by)


def point_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Long table of (pair, x, y) points."""
    entries = [
        F.struct(
            pair_label(F.lit(x), F.lit(y)).alias("pair"),
            F.col(x).cast("double").alias("x"),
            F.col(y).cast("double").alias("y"),
        )
        for x, y in pairs
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def parallel_axes(df: DataFrame, group: str, axes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Long table (group, axis, value) of the rows, and the group medians per axis."""
    entries = [F.struct(F.lit(a).alias("axis"), F.col(a).cast("double").alias("value")) for a in axes]
    lines = df.select(group, F.inline(F.array(*entries)))
    medians = quantiles(df, axes, {"median": 0.5}, [group]).withColumnRenamed("column", "axis")
    return lines, medians
