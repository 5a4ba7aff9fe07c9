"""Nearest neighbours by inner product with a vantage-point tree for each shard.

Every vector is indexed. In a shard each vector gets one more component that makes all of them
equally long; the nearest in distance is then the one with the largest inner product, and the
triangle inequality holds. A tree splits its vectors at the median distance from a vantage
point. A search goes to the nearer side first and leaves out the other one if it lies farther
than ``factor`` times the distance of the k-th best so far: factor 1 is exact, a smaller one is
faster and may miss some.

Queries are stated rows, dealt out in blocks; a block meets a shard in one task, and the best
of all shards are ranked with partial top-k before the shuffle.
"""

from __future__ import annotations

import pickle
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import stored

#: Vectors of a shard, queries of a block (on average, by a hash of the id).
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
LEAF = 64
#: Vantage points tried for a node, and vectors they are judged by.
TRIED, JUDGED = 4, 64
FACTOR = 1.0


class Tree(NamedTuple):
    """Distinct vectors in leaf order, their ids, and the nodes.

    Node i splits at distance ``radius[i]`` from ``vantage[i]`` into ``near[i]`` and ``far[i]``;
    a leaf has near -1 and holds the vectors from ``start[i]`` to ``stop[i]``.
    """

    vectors: np.ndarray
    ids: list[np.ndarray]
    length: float
    vantage: np.ndarray
    radius: np.ndarray
    near: np.ndarray
    far: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def build(ids: np.ndarray, vectors: np.ndarray, seed: int = 0) -> Tree:
    """The tree of a shard's rows; equal vectors are one entry with all of their ids."""
    draw = np.random.default_rng(seed)
    rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, first, entry = np.unique(rows, return_index=True, return_inverse=True)
    order = np.lexsort((ids, entry))
    order = order[np.append(True, (np.diff(entry[order]) != 0) | (np.diff(ids[order]) != 0))]
    ids_of = np.split(ids[order], np.flatnonzero(np.diff(entry[order])) + 1)
    points = vectors[first]
    square = np.einsum("ij,ij->i", points, points)
    length = float(square.max())
    points = np.column_stack([points, np.sqrt(np.maximum(length - square, 0))])
    place = np.arange(len(points))
    nodes: list[list] = []
    todo = [(0, len(points), None, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        me = len(nodes)
        nodes.append([np.zeros(points.shape[1]), 0.0, -1, -1, a, b])
        if parent is not None:
            nodes[parent][2 + side] = me
        if b - a <= LEAF:
            continue
        mine = points[place[a:b]]
        tried = mine[draw.integers(0, b - a, TRIED)]
        sample = mine[draw.integers(0, b - a, JUDGED)]
        spread = [np.linalg.norm(sample - v, axis=1).std() for v in tried]
        vantage = tried[int(np.argmax(spread))]
        distance = np.linalg.norm(mine - vantage, axis=1)
        middle = (b - a) // 2
        split = np.argpartition(distance, middle)
        place[a:b] = place[a:b][split]
        nodes[me][:2] = vantage, float(distance[split[middle]])
        todo += [(a, a + middle, me, 0), (a + middle, b, me, 1)]
    vantage, *rest = zip(*nodes)
    return Tree(points[place], [ids_of[i] for i in place], length, np.array(vantage), *map(np.array, rest))


def search(
    tree: Tree, own: np.ndarray, queries: np.ndarray, k: int, factor: float
) -> tuple[np.ndarray, np.ndarray]:
    """(scores, entries) of the ``k`` best entries for each query, best first; -1 pads.

    Entries are ranked by score, then by their smallest id that is not the query's ``own``; one
    without such an id is left out. So the k best rows are among the entries. Matrix products
    only tell which scores to work out, as sums in order of the components: equal vectors score
    equally, and rounding breaks no tie.

    Each query first goes down to the leaf on its own side of every node, which bounds its k-th
    best distance. Then all queries go through the tree together; one takes part in a side only
    if that side begins within ``factor`` times its k-th best distance.
    """
    n, k, width = len(queries), min(k, len(tree.vectors)), queries.shape[1]
    score, best, home = np.full((n, k), -np.inf), np.full((n, k), -1), np.full(n, -1)
    none = np.iinfo(np.int64).max  # stands beside a score of -inf only
    least = np.full((n, k), none)
    first, single = np.array([x[0] for x in tree.ids]), np.array([len(x) == 1 for x in tree.ids])
    second = np.array([x[min(1, len(x) - 1)] for x in tree.ids])
    longer = np.column_stack([queries, np.zeros(n)])
    square = np.einsum("ij,ij->i", queries, queries)
    base = square + tree.length
    rounding = 16 * (width + 8) * np.finfo(float).eps
    slack, far_slack = rounding * np.sqrt(square * tree.length), 2 * np.sqrt(rounding * base)

    def compare(leaf: int, active: np.ndarray) -> None:
        a, b = tree.start[leaf], tree.stop[leaf]
        found = longer[active] @ tree.vectors[a:b].T
        row, column = np.nonzero(found >= (score[active, -1] - slack[active])[:, None])
        at, entry = active[row], a + column
        mine = first[entry] == own[at]
        some = ~(mine & single[entry])
        row, column, at, entry, mine = (x[some] for x in (row, column, at, entry, mine))
        exact = np.zeros(len(at))
        for d in range(width):
            exact += queries[at, d] * tree.vectors[entry, d]
        ids = np.where(mine, second[entry], first[entry])
        last = score[at, -1]
        better = (exact > last) | ((exact == last) & (ids < least[at, -1]))
        if not better.any():
            return
        of, row = np.unique(row[better], return_inverse=True)
        rows, column = active[of], k + column[better]
        scores, entries, tied = (
            np.concatenate([old[rows], np.full((len(rows), b - a), empty)], 1)
            for old, empty in ((score, -np.inf), (best, -1), (least, none))
        )
        scores[row, column], entries[row, column], tied[row, column] = exact[better], entry[better], ids[better]
        top = np.lexsort((tied, -scores), axis=1)[:, :k]
        score[rows], best[rows], least[rows] = (np.take_along_axis(x, top, 1) for x in (scores, entries, tied))

    def beyond(node: int, active: np.ndarray) -> np.ndarray:
        """How far outside the near side each query lies."""
        square = base[active] - 2 * (longer[active] @ tree.vantage[node])
        return np.sqrt(np.maximum(square, 0)) - tree.radius[node]

    def reach(active: np.ndarray) -> np.ndarray:
        square = base[active] - 2 * score[active, -1]
        return factor * np.sqrt(np.maximum(square, 0)) + far_slack[active]

    todo = [(0, np.arange(n))]
    while todo:
        node, active = todo.pop()
        if not len(active):
            continue
        if tree.near[node] < 0:
            home[active] = node
            compare(node, active)
        else:
            inside = beyond(node, active) <= 0
            todo += [(tree.near[node], active[inside]), (tree.far[node], active[~inside])]
    todo = [(0, np.arange(n), np.full(n, -np.inf))]
    while todo:
        node, active, distance = todo.pop()
        within = distance <= reach(active)  # the reach has shrunk since
        active, distance = active[within], distance[within]
        if not len(active):
            continue
        if tree.near[node] < 0:
            other = active[home[active] != node]
            if len(other):
                compare(node, other)
            continue
        gap = beyond(node, active)
        todo.append((tree.far[node], active, np.maximum(distance, -gap)))
        todo.append((tree.near[node], active, np.maximum(distance, gap)))
    return score, best


def nearest(tree: Tree, own: np.ndarray, queries: np.ndarray, k: int, factor: float) -> pd.DataFrame:
    """query_id, vec_id, score of the k best rows of a shard other than the query's own."""
    score, best = search(tree, own, queries, k, factor)
    row, column = np.nonzero(best >= 0)
    entry = best[row, column]
    # more than k + 1 ids of one vector cannot be among the k best
    size = np.minimum(np.array([len(x) for x in tree.ids]), k + 1)
    ids = np.concatenate([x[: k + 1] for x in tree.ids])
    first, many = (np.cumsum(size) - size)[entry], size[entry]
    at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
    row, vec, of = np.repeat(row, many), ids[at], np.repeat(score[row, column], many) + 0.0
    other = vec != own[row]
    row, vec, of = row[other], vec[other], of[other]
    order = np.lexsort((vec, -of, row))
    row, vec, of = row[order], vec[order], of[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return pd.DataFrame({"query_id": own[row], "vec_id": vec, "score": of})[rank < k]


def usable(vector: Column) -> Column:
    """Whether a vector is finite throughout and not zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    fine = F.forall(vector, number) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def index(vectors: DataFrame) -> DataFrame:
    """One row (dim, shard, shards, tree) for each shard of ``vectors`` (vec_id, embedding).

    Every usable vector with an id is in a tree; a repeated row is one entry. Vectors of
    different length are in different shards.
    """
    rows = (
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
        .withColumn("dim", F.size("v"))
    )
    counts = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    dealt = rows.join(F.broadcast(counts), "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards").cast("int"))

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        ids, points = frame["vec_id"].to_numpy(np.int64), np.array(frame["v"].tolist(), float)
        dim, shard, shards = (int(frame[c].iloc[0]) for c in ("dim", "shard", "shards"))
        tree = pickle.dumps(tuple(build(ids, points, shard)))
        return pd.DataFrame({"dim": [dim], "shard": [shard], "shards": [shards], "tree": [tree]})

    return dealt.groupBy("dim", "shard", "shards").applyInPandas(make, "dim int, shard int, shards int, tree binary")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """The ``k`` nearest found of ``vectors`` for each of ``queries`` (both vec_id, embedding).

    Columns: query_id, rank from 1, vec_id, score. Nearest is the largest inner product, ties go
    to the smaller id; rows with the query's own id are no candidates. Vectors that are null,
    zero or not finite, and null ids, take no part; vectors meet others of their length only.
    Repeated rows count once; other columns are ignored; empty tables give no rows.
    """
    trees = stored(index(vectors))
    asked = (
        queries.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
        .distinct()
    )
    asked = asked.withColumn("dim", F.size("v"))
    shards = trees.select("dim", "shards").distinct()  # one row for each length of vectors
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks").cast("int")
    left = trees.join(F.broadcast(blocks), "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    right = (
        asked.join(F.broadcast(blocks), "dim")
        .withColumn("block", block)
        .join(F.broadcast(shards), "dim")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    )
    key = ["dim", "shard", "block"]

    def meet(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree = Tree(*pickle.loads(shard["tree"].iloc[0]))
        return nearest(tree, asked["vec_id"].to_numpy(np.int64), np.array(asked["v"].tolist(), float), k, factor)

    found = (
        left.select(*key, "tree").groupBy(*key)
        .cogroup(right.select(*key, "vec_id", "v").groupBy(*key))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
