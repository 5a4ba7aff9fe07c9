"""Exact search for the largest integer inner products, dimension block by dimension block.

Candidates lie in blocks in vertical layout: all values of one dimension stand together. A block
of queries goes through them a few dimensions at a time, those with the most mass first. After
each step a pair of a query and a candidate can still gain at most the product of the masses
(lengths) of their remaining dimensions. Pairs that cannot reach the query's k-th best score so
far are done; candidates and queries without a pair are compacted away, and once few pairs are
left these go on alone. What is left after the last dimension has its exact score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import stored

#: Candidates and queries of a block (on average, by a hash), and blocks of candidates that one
#: task goes through with a block of queries, carrying the k-th best scores on.
BLOCK_ROWS, QUERY_ROWS, PART_BLOCKS = 4096, 2048, 8
#: Dimensions of a step.
STEP = 8
#: Below this share of the pairs of a block, the remaining pairs go on alone.
FEW = 0.1
#: Pairs that are ranked at once.
RANKED = 1 << 20
_LOWEST, _NO_ID = -(1 << 62), np.iinfo(np.int64).max


class Best:
    """The ``k`` best candidates so far of each query: highest score, then smallest id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.k = ids, k
        self.score = np.full((len(ids), k), _LOWEST, np.int64)
        self.id = np.full((len(ids), k), _NO_ID, np.int64)
        mass = np.square(queries, dtype=np.float64)
        self.order = np.argsort(-mass.sum(0), kind="stable")
        self.queries = queries[:, self.order]
        self.rest = _rest(mass[:, self.order].T)
        self.most = np.abs(self.queries).max(0, initial=0).astype(np.float64)

    def meet(self, ids: np.ndarray, columns: np.ndarray) -> int:
        """Rank a block of candidates: ``columns`` has a row for each dimension. Returns how many
        products of single numbers were computed."""
        columns = columns[self.order]
        bound = float(self.most @ np.abs(columns).max(1, initial=0).astype(np.float64))
        if bound >= 2.0**62:
            raise ValueError("inner products of these vectors do not fit a long")
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
        queries, columns = self.queries.astype(kind), columns.astype(kind)
        rest = _rest(np.square(columns, dtype=np.float64))
        exactness = np.finfo(np.float32 if kind == np.float32 else np.float64).eps
        slack = 0.5 + 16 * exactness * self.rest[0].max(initial=0) * rest[0].max(initial=0)
        least = np.where(self.id[:, -1] == _NO_ID, -np.inf, self.score[:, -1] - slack)
        rows, alive = np.arange(len(queries)), np.arange(len(ids))
        partial = np.zeros((len(rows), len(alive)), kind)
        work, steps = 0, range(0, len(columns), STEP)
        for step, at in enumerate(steps):
            open_pairs = partial + np.outer(self.rest[step][rows], rest[step][alive]) >= least[rows][:, None]
            left = np.count_nonzero(open_pairs)
            if left <= FEW * open_pairs.size:
                x, y = np.nonzero(open_pairs)
                return work + self._alone(ids, queries, columns, rest, least, step, rows[x], alive[y], partial[x, y])
            some, others = open_pairs.any(1), open_pairs.any(0)
            if some.mean() < 0.9 or others.mean() < 0.9:
                rows, alive, partial = rows[some], alive[others], partial[np.ix_(some, others)]
            partial += queries[rows, at : at + STEP] @ columns[at : at + STEP, alive]
            work += partial.size * len(columns[at : at + STEP])
        if not partial.size:
            return work
        mine = ids[alive][None, :] == self.own[rows][:, None]
        if mine.any():
            partial[mine] = _LOWEST if kind == np.int64 else -np.inf
        reach = least[rows]
        if len(alive) > self.k:  # a candidate below the k-th best of this block alone is none
            reach = np.maximum(reach, np.partition(partial, len(alive) - self.k, 1)[:, -self.k])
        for a in range(0, len(rows), slab := max(1, RANKED // len(alive))):
            x, y = np.nonzero((partial[a : a + slab] >= reach[a : a + slab, None]) & ~mine[a : a + slab])
            self._rank(rows[a + x], ids[alive[y]], partial[a + x, y])
        return work

    def _alone(self, ids, queries, columns, rest, least, step, row, column, score) -> int:
        """Go on with single pairs from a step on."""
        upright, work = np.ascontiguousarray(columns.T), 0
        for step in range(step, len(range(0, len(columns), STEP))):
            at = slice(step * STEP, (step + 1) * STEP)
            score = score + np.einsum("ij,ij->i", queries[row, at], upright[column, at])
            work += len(row) * upright[:1, at].size
            going = score + self.rest[step + 1][row] * rest[step + 1][column] >= least[row]
            row, column, score = row[going], column[going], score[going]
        other = ids[column] != self.own[row]
        self._rank(row[other], ids[column[other]], score[other])
        return work

    def _rank(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Put pairs among the best of their queries."""
        if not len(row):
            return
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, self.k), row])
        score = np.concatenate([self.score[touched].ravel(), score.astype(np.int64)])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        keep = rank < self.k
        self.score[row[keep], rank[keep]] = score[keep]
        self.id[row[keep], rank[keep]] = ids[keep]


def _rest(squares: np.ndarray) -> np.ndarray:
    """For each step, and after the last, the length of each vector in the dimensions still to
    come; ``squares`` has a row for each dimension."""
    behind = np.concatenate([np.cumsum(squares[::-1], 0)[::-1], np.zeros((1, squares.shape[1]))])
    steps = [*range(0, len(squares), STEP), len(squares)]
    return np.sqrt(behind[steps])


def finite(vector: Column) -> Column:
    """Whether a vector is there and each of its components is a finite number."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, number), F.lit(False))


_PACKED = "dim int, block int, ids binary, size int, kind string, columns binary"


def _packed(rows: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """``rows`` (vec_id, vector) in blocks in vertical layout, by ascending id, and how many
    numbers of blocks there are. Vectors of different length are in different blocks."""
    rows = stored(rows.withColumn("dim", F.size("vector")))
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        ids = group["vec_id"].to_numpy()
        values = group["vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        kind = np.result_type(np.min_scalar_type(values.min(initial=0)), np.min_scalar_type(-values.max(initial=0) - 1))
        cells = [group["dim"][0].as_py(), group["block"][0].as_py(), ids.tobytes(), len(ids), kind.str]
        cells.append(np.ascontiguousarray(values.T.astype(kind)).tobytes())
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.string(), pa.binary()]
        names = ["dim", "block", "ids", "size", "kind", "columns"]
        return pa.table([pa.array([c], k) for c, k in zip(cells, kinds)], names=names)

    packed = dealt.select("dim", "block", "vec_id", "vector").groupBy("dim", "block").applyInArrow(pack, _PACKED)
    return stored(packed), blocks


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and columns of a block."""
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["columns"], row["kind"]).reshape(-1, row["size"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for each of ``queries``.

    Both have vec_id and ``vector``, an array of longs; an inner product must fit a long, else
    the search fails. Columns: query_id, rank from 1, vec_id, score. All candidates are searched
    and results are exact; ties go to the smaller id; rows with the query's own id are no
    candidates. Null ids, null vectors and vectors with a null take no part; vectors meet others
    of their length only, and all inner products of empty ones are 0. Repeated rows count once;
    one id with several vectors is several candidates and several queries. Other columns are
    ignored; empty tables give no rows.
    """
    fit = "vec_id IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)"
    asked, searched = (df.where(fit).select("vec_id", "vector").distinct() for df in (queries, vectors))
    # of equal vectors only the k + 1 smallest ids can be among the k best of a query
    equal = W.partitionBy("vector").orderBy("vec_id")
    searched = searched.withColumn("_nth", F.row_number().over(equal)).where(F.col("_nth") <= k + 1).drop("_nth")
    candidates, blocks = _packed(searched, BLOCK_ROWS)
    rows, query_blocks = _packed(asked, QUERY_ROWS)
    parts = -(-blocks // PART_BLOCKS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["dim", "query_block", "part"]
    left = rows.withColumn("part", every(parts)).withColumnRenamed("block", "query_block")
    right = candidates.withColumn("query_block", every(query_blocks)).withColumn("part", F.pmod("block", F.lit(parts)))
    names = ["dim", "query_block", "nth", "query_id", "vec_id", "score"]

    def search(asked: pa.Table, found: pa.Table) -> pa.Table:
        columns = [np.zeros(0, np.int64)] * len(names)
        if asked.num_rows and found.num_rows:
            head = asked.slice(0, 1).to_pylist()[0]
            own, values = _unpacked(head)
            best = Best(own, values.T, k)
            for i in range(found.num_rows):
                best.meet(*_unpacked(found.slice(i, 1).to_pylist()[0]))
            row, rank = np.nonzero(best.id != _NO_ID)
            fixed = [np.full(len(row), head[c]) for c in ("dim", "query_block")]
            columns = [*fixed, row, own[row], best.id[row, rank], best.score[row, rank]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, ", ".join(f"{n} long" for n in names))
    order = W.partitionBy("dim", "query_block", "nth").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
