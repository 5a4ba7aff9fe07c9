"""Discretisation, frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.sizing import durable
from tidemark.operators.ordering import quantiles

# Thresholds of the reported rules, level names.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.1, 0.3, 1.2
LEVELS = ("Low", "Mid", "High")


def tercile_items(df: DataFrame, cols: Sequence[str], name: str = "items") -> DataFrame:
    """Append one item per column: ``<column>_Low``, ``_Mid`` or ``_High`` by terciles.

    The cut points are one row per column, read as a subquery.
    """
    cuts = quantiles(df, cols, {"t1": 1 / 3, "t2": 2 / 3})
    entry = F.struct("column", F.struct("t1", "t2").alias("cut"))
    table = cuts.agg(F.map_from_entries(F.collect_list(entry))).scalar()

    def item(c: str) -> Column:
        cut = table[c]
        low, mid, high = (F.lit(f"{c}_{level}") for level in LEVELS)
        value = F.col(c)
        return (
            F.when(value <= cut["t1"], low)
            .when(value <= cut["t2"], mid)
            .when(value.isNotNull(), high)
        )

    nothing = F.array(F.lit(None).cast("string"))
    return df.withColumn(name, F.sort_array(F.array_except(F.array(*[item(c) for c in cols]), nothing)))


def basket_counts(df: DataFrame, items: str = "items") -> DataFrame:
    """Rows per distinct basket. Discretised rows have few different baskets, so the
    mining below works on a table whose size does not grow with the rows."""
    return df.groupBy(items).agg(F.count(F.lit(1)).alias("n"))


def _combinations(items: Column, size: int) -> Column:
    """All ``size``-element subsets of a sorted array, as an array of arrays."""
    level = F.transform(items, lambda v: F.array(v))
    for _ in range(size - 1):
        level = F.flatten(
            F.transform(
                level,
                lambda s: F.transform(
                    F.filter(items, lambda v: v > F.element_at(s, -1)),
                    lambda v: F.concat(s, F.array(v)),
                ),
            )
        )
    return level


def frequent_itemsets(
    baskets: DataFrame, min_support: float = MIN_SUPPORT, max_items: int | None = None
) -> DataFrame:
    """Itemsets held by at least ``min_support`` of the rows, of any size (or ``max_items``).

    ``baskets`` has sorted ``items`` and a row count ``n``. Items that are rare on their
    own are removed first; there are at most basket length / min_support others. Every subset
    of the rest of a basket is counted, which suits baskets of a few items, such as one for
    each column; ``grown_itemsets`` suits long ones. The baskets are stored first, because they
    are read several times.
    """
    baskets = durable(baskets)
    total = baskets.agg(F.sum("n")).scalar()
    enough = F.col("freq") >= F.lit(min_support) * total
    single = baskets.select(F.explode("items").alias("item"), "n")
    common = single.groupBy("item").agg(F.sum("n").alias("freq")).where(enough)
    keep = common.agg(F.collect_set("item")).scalar()
    reduced = (
        baskets.select(F.array_intersect("items", keep).alias("items"), "n")
        .groupBy("items")
        .agg(F.sum("n").alias("n"))
    )
    longest = reduced.agg(F.max(F.size("items"))).first()[0] or 0
    sizes = range(1, min(longest, max_items or longest) + 1)
    subsets = F.concat(*[_combinations(F.col("items"), k) for k in sizes or (1,)])
    counted = reduced.select(F.explode(subsets).alias("items"), "n").groupBy("items")
    return (
        counted.agg(F.sum("n").alias("freq"))
        .where(enough)
        .select("items", "freq", (F.col("freq") / total).alias("support"))
    )


def grown_itemsets(
    df: DataFrame, items: str = "items", min_support: float = MIN_SUPPORT, max_items: int | None = None
) -> DataFrame:
    """The same itemsets by parallel FP-growth, for baskets of any length and variety."""
    grown = FPGrowth(itemsCol=items, minSupport=min_support).fit(df.select(items)).freqItemsets
    total = df.agg(F.count(F.lit(1))).scalar()
    if max_items is not None:
        grown = grown.where(F.size("items") <= max_items)
    return grown.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / total).alias("support")
    )


def association_rules(
    itemsets: DataFrame,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """Rules between disjoint parts of every frequent itemset, multi-item on both sides.

    Every part of a frequent itemset is frequent, so both supports are found by joining
    the (stored) itemsets back. A rule that always holds has no conviction.
    """
    itemsets = durable(itemsets)
    longest = itemsets.agg(F.max(F.size("items"))).first()[0] or 0
    part = F.concat(*[_combinations(F.col("items"), k) for k in range(1, max(longest, 2))])
    split = (
        itemsets.where(F.size("items") >= 2)
        .select("items", "support", F.explode(part).alias("antecedent"))
        .where(F.size("antecedent") < F.size("items"))
        .withColumn("consequent", F.array_except("items", "antecedent"))
    )
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("sa"))
    right = itemsets.select(F.col("items").alias("consequent"), F.col("support").alias("sc"))
    both = split.join(left, "antecedent").join(right, "consequent")
    confidence = F.col("support") / F.col("sa")
    rules = both.select(
        F.concat_ws(", ", "antecedent").alias("antecedents"),
        F.concat_ws(", ", "consequent").alias("consequents"),
        "support",
        confidence.alias("confidence"),
        (confidence / F.col("sc")).alias("lift"),
        (F.col("support") - F.col("sa") * F.col("sc")).alias("leverage"),
        ((1 - F.col("sc")) / F.nullif(1 - confidence, F.lit(0.0))).alias("conviction"),
    )
    return rules.where((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
