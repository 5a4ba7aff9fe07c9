"""Mixing sources to target weights.

Weights are given along a tree of columns (domain, language, source, say). A token budget is
passed down the tree: each node shares its budget among its children by their weights, none
gets more than it holds (its tokens times the epochs allowed), and what one cannot take goes to
its siblings. As a node's budget never exceeds what the leaves below it hold, shortages are made
up among siblings first and reach an ancestor's siblings only when a whole subtree is short.

A leaf's budget is the prefix of its epochs: whole passes over its documents, then documents in
the order of a seeded hash up to the budget. The prefix ends at a cut, one hash value for each
leaf, so choosing documents needs no sort of a leaf: tokens are summed per range of hashes, and
only the range in which the budget ends is put in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import stored

#: Rows of the hash range that is put in order, on average.
RANGE_ROWS = 10_000
#: A leaf table of at most this many rows is broadcast.
BROADCAST_LEAVES = 100_000
#: Level value of rows without one.
MISSING = "none"

Weights = Mapping[tuple[str, ...], float]


def words(text: Column) -> Column:
    """The runs of a text between blanks, counted as its tokens."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\r\f]+"), F.lit(0))).cast("long")


def _levelled(levels: Sequence[str | Column]) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in levels]
    return [F.coalesce(c.cast("string"), F.lit(MISSING)).alias(f"l{i}") for i, c in enumerate(cols)]


def _weight(cols: Sequence[str], weights: Weights, default: float) -> Column:
    """The weight of a node; a node that is not named has the default."""
    same = {path: w for path, w in weights.items() if len(path) == len(cols)}
    if not same:
        return F.lit(float(default))
    pairs = [x for path, w in same.items() for x in (F.lit("\u0001".join(path)), F.lit(float(w)))]
    return F.coalesce(F.create_map(*pairs)[F.concat_ws("\u0001", *cols)], F.lit(float(default)))


def _shared(nodes: DataFrame, parent: Sequence[str], name: Sequence[str]) -> DataFrame:
    """``given``: each node's share of ``of_parent`` by ``weight``, at most ``holds``, what is
    left over going to its siblings.

    In order of holds / weight, a child takes all it holds if the budget still suffices when
    all later ones take in proportion; the others share the rest.
    """
    ratio = F.col("holds") / F.col("weight")
    by = W.partitionBy(*parent).orderBy(ratio, *name)
    before = F.coalesce(F.sum("holds").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(by.rowsBetween(W.currentRow, W.unboundedFollowing))
    full = before + ratio * behind <= F.col("of_parent")
    whole = W.partitionBy(*parent)
    marked = nodes.withColumn("full", full)
    rest = F.col("of_parent") - F.sum(F.when(F.col("full"), F.col("holds")).otherwise(0.0)).over(whole)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(whole)
    part = F.when(F.col("full"), F.col("holds")).otherwise(rest * F.col("weight") / open_weight)
    return marked.withColumn("given", F.least(part, F.col("holds"))).drop("full")


def budgets(leaves: DataFrame, depth: int, weights: Weights, budget: Column, epochs: int, default: float = 1.0) -> DataFrame:
    """``leaves`` (l0, l1, ..., tokens) with ``budget``, the tokens to take from each.

    Nodes of weight 0 get nothing, and hold nothing for their parent. The tables here have one
    row for each node of the tree.
    """
    cols = [f"l{i}" for i in range(depth)]
    tables: dict[int, DataFrame] = {}
    below = leaves.select(*cols, (F.col("tokens") * float(epochs)).alias("holds"))
    for level in range(depth, 0, -1):
        at = cols[:level]
        node = below.groupBy(*at).agg(F.sum("holds").alias("holds"))
        node = node.withColumn("weight", _weight(at, weights, default))
        node = node.withColumn("holds", F.when(F.col("weight") > 0, F.col("holds")).otherwise(0.0))
        tables[level] = below = node.where("holds > 0")
    total = below.agg(F.sum("holds").alias("all"))
    given = total.select(F.least(budget, F.col("all")).alias("given"))
    for level in range(1, depth + 1):
        parent = cols[: level - 1]
        if parent:
            up = given.select(*parent, F.col("given").alias("of_parent"))
            nodes = tables[level].join(up, parent)
        else:
            nodes = tables[level].withColumn("of_parent", given.scalar())
        given = _shared(nodes, parent, cols[:level])
    taken = given.select(*cols, F.floor(F.col("given") + 1e-6).cast("long").alias("budget"))
    return leaves.join(taken, cols, "left").withColumn("budget", F.coalesce("budget", F.lit(0).cast("long")))


def _order(seed: int, epoch: Column, doc_id: Column) -> Column:
    key = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.md5(F.encode(key, "UTF-8"))


class Mix:
    """The share of each leaf, and where its last epoch ends.

    ``docs`` has doc_id and the ``levels`` of the tree (columns or their names); ``tokens`` counts a
    row's tokens. ``share`` of all tokens is the budget. At most ``epochs`` passes are made over
    a leaf. Rows without a level's value are in the leaf "none" of that level; rows with equal
    ids stand at one place of the order and share its cut; a null text has no tokens.
    """

    def __init__(
        self,
        docs: DataFrame,
        levels: Sequence[str | Column],
        weights: Weights,
        share: float,
        epochs: int = 1,
        seed: int = 0,
        tokens: Column | None = None,
    ):
        self.levels, self.seed, self.epochs = levels, seed, epochs
        self.tokens = words(F.col("text")) if tokens is None else tokens
        cols = [f"l{i}" for i in range(len(levels))]
        rows = stored(docs.select(F.col("doc_id").alias("id"), *_levelled(levels), self.tokens.alias("n")))
        leaves = rows.groupBy(*cols).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        budget = F.floor(F.lit(share) * leaves.agg(F.sum("tokens")).scalar()).cast("double")
        leaves = stored(budgets(leaves, len(cols), weights, budget, epochs))
        passes = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
        leaves = leaves.withColumn("passes", passes).withColumn("left", F.col("budget") - F.col("passes") * F.col("tokens"))
        largest = leaves.agg(F.max("rows")).first()[0] or 1
        digits = max(1, min(7, len(f"{largest // RANGE_ROWS:x}")))
        self.leaves = stored(self._cut(rows, leaves, cols, digits))
        self.cols = cols

    def _cut(self, rows: DataFrame, leaves: DataFrame, cols: list[str], digits: int) -> DataFrame:
        """``leaves`` with the order value ``cut`` at which the last epoch ends and the tokens
        ``of_cut`` that are left for it there."""
        open_leaves = leaves.where("left > 0").select(*cols, "passes", "left")
        placed = rows.join(self._small(open_leaves), cols).select(
            *cols, "left", "n", _order(self.seed, F.col("passes"), F.col("id")).alias("o")
        )
        ranges = placed.groupBy(*cols, "left", F.substring("o", 1, digits).alias("range")).agg(F.sum("n").alias("n"))
        so_far = F.sum("n").over(W.partitionBy(*cols).orderBy("range"))
        ends = (
            ranges.withColumn("upto", so_far)
            .where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
            .select(*cols, "range", (F.col("left") - F.col("upto") + F.col("n")).alias("inside"))
        )
        last = placed.withColumn("range", F.substring("o", 1, digits)).join(self._small(ends), [*cols, "range"])
        one = last.groupBy(*cols, "inside", "o").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(W.partitionBy(*cols).orderBy("o"))
        cut = (
            one.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("inside")) & (F.col("upto") - F.col("n") < F.col("inside")))
            .select(*cols, F.col("o").alias("cut"), (F.col("inside") - F.col("upto") + F.col("n")).alias("of_cut"))
        )
        return leaves.join(cut, cols, "left")

    @staticmethod
    def _small(leaves: DataFrame) -> DataFrame:
        """``leaves``, to be broadcast if there are few; else Spark joins by a shuffle and
        splits the leaves that hold many rows."""
        few = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
        return F.broadcast(leaves) if few else leaves

    def select(self, docs: DataFrame) -> DataFrame:
        """The chosen rows of ``docs``, one for each epoch they are in, with all their columns
        and the columns epoch, n_tokens, take_tokens (less than n_tokens at the cut)."""
        kept = [c for c in docs.columns if c not in ("epoch", "n_tokens", "take_tokens")]
        rows = docs.select(F.struct(*kept).alias("doc"), F.col("doc_id").alias("id"), *_levelled(self.levels), self.tokens.alias("n"))
        leaves = self._small(self.leaves.select(*self.cols, "passes", "cut", "of_cut"))
        epochs = F.sequence(F.lit(0), F.least(F.col("passes"), F.lit(self.epochs - 1)))
        every = rows.join(leaves, self.cols).withColumn("epoch", F.explode(epochs))
        order = _order(self.seed, F.col("epoch"), F.col("id"))
        whole = (F.col("epoch") < F.col("passes")) | F.coalesce(order < F.col("cut"), F.lit(False))
        take = F.when(whole, F.col("n")).when(order == F.col("cut"), F.least("n", "of_cut"))
        return every.withColumn("take", take).where("take IS NOT NULL").select(
            "doc.*", "epoch", F.col("n").alias("n_tokens"), F.col("take").alias("take_tokens")
        )
