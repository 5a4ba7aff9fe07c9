"""Jaccard join of documents on word shingles by chosen paths.

Every text becomes the set of its word shingles; equal sets are one set with copies. A run
sends each set down the paths of sampled tokens: at a node the set goes on with each of its
tokens whose hash, seeded by the path, is below 1 / (threshold * size), on average a little more
than one. Similar sets share tokens and so meet in a node. Nodes of many sets are split again, by twice
as many tokens, small ones are compared by brute force, and the runs are repeated until a pair
at the threshold is met with the target recall. The tokens of all levels are sampled in one
pass over the texts.

The comparison in a node uses sketches with a margin and yields only which sets hang together.
Each such group is then gathered once, in blocks of bounded size, and every pair in it is
verified on the whole sets, which are made again from the texts for the sets concerned. Results
are counts and classes; pairs are never rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import connected_components, document_batches, give_back, stored
from tidemark.llm.words import split_words

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9995
#: Nodes of more sets are split, at most this often.
SPLIT, DEPTH = 4096, 3
#: Tokens chosen below the first level, in proportion to those chosen there.
DEEPER = 2
#: A node's lowest bits are its run.
RUN_BITS = 6
#: Bits of the filter that marks the sets to be made again; its size is fixed.
FILTER_BITS = 1 << 23
#: Sets compared in one task; larger nodes are compared block by block.
BLOCK = 4096
#: Minima in a sketch; pairs whose estimate is within MARGIN deviations are kept.
SKETCH, MARGIN = 64, 4.0
#: Tokens and sets of a block that is verified in one task.
BLOCK_TOKENS, BLOCK_SETS = 2_000_000, 2_000
CHUNK_BYTES = 1 << 20

_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_TOKENS = np.dtype("<u8")


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a node at ``depth`` with ``recall``.

    Such a pair shares one chosen token on average at the first level and ``DEEPER`` below, so
    it goes on together with probability 1 - exp(-1) and then 1 - exp(-DEEPER).
    """
    q = (1 - math.exp(-1)) * (1 - math.exp(-DEEPER)) ** (depth - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``words``-word shingles of each text. A text of fewer words
    is one shingle, one without words has none."""
    split = split_words(texts, digits=True)
    hashes = np.array([xxhash.xxh64_intdigest(f.encode("utf-8", "surrogatepass")) for f in split.forms], np.uint64)
    of_word = hashes[split.form_of] if len(split.forms) else np.zeros(0, np.uint64)
    ends = np.cumsum(np.bincount(split.text_of, minlength=len(texts)))
    rolled = np.zeros(len(of_word), np.uint64)
    n = len(of_word)
    for i in range(words):
        upto = max(0, n - words + 1)
        rolled[:upto] = (rolled[:upto] + of_word[i : i + upto]) * _MIX
    rolled = _mixed(rolled)
    out, at = [], 0
    for end in ends:
        size = int(end) - at
        if size >= words:
            out.append(np.unique(rolled[at : end - words + 1]))
        elif size:
            whole = np.uint64(size)
            with np.errstate(over="ignore"):
                for h in of_word[at:end]:
                    whole = (whole + h) * _MIX
            out.append(_mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at = int(end)
    return out


def chosen(tokens: np.ndarray, sizes: np.ndarray, runs: int, level: int, threshold: float) -> list[np.ndarray]:
    """For each set, the nodes (first level) or steps (below) that its chosen tokens lead to.

    ``tokens`` holds the sets one after the other. In every run a set chooses the tokens whose
    hash is below its limit, so equal tokens are chosen alike by sets of like size.
    """
    most = (1 if level == 1 else DEEPER) / (threshold * np.maximum(1, sizes))
    limit = np.repeat((np.minimum(1.0, most) * 2.0**62).astype(np.uint64), sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places, steps = [], []
    for run in range(runs):
        h = _mixed(tokens ^ _mixed(np.array([run * DEPTH + level], np.uint64) * _MIX2))
        at = np.flatnonzero((h >> np.uint64(2)) <= limit)
        places.append(owner[at])
        steps.append((_mixed(h[at] + _MIX) & ~np.uint64((1 << RUN_BITS) - 1)) | np.uint64(run))
    place, step = np.concatenate(places), np.concatenate(steps).view(np.int64)
    order = np.argsort(place, kind="stable")
    return np.split(step[order], np.searchsorted(place[order], np.arange(1, len(sizes))))


_FACTORS = _mixed(np.arange(1000, 1000 + SKETCH, dtype=np.uint64)) | np.uint64(1)


_PREPARED = (
    "doc_id long, text_hash long, k1 long, k2 long, size long, sketch binary, "
    + ", ".join(f"level{i} array<long>" for i in range(1, DEPTH + 1))
)


def _parts(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``CHUNK_BYTES`` of text."""
    for batch in batches:
        rows = max(1, batch.num_rows * CHUNK_BYTES // max(CHUNK_BYTES, batch.column(text).nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _prepared(words: int, threshold: float, runs: int):
    """Key, size, sketch and sampled tokens of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, 1):
            sets = shingle_sets(part.column(1), words)
            sizes = np.array([len(s) for s in sets])
            flat = np.concatenate([np.zeros(0, np.uint64), *sets])
            some = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[some]
            sketch = np.zeros((len(sets), SKETCH), np.uint16)
            for j, factor in enumerate(_FACTORS if len(some) else ()):
                sketch[some, j] = np.minimum.reduceat(flat * factor, starts) % np.uint64(65521)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            columns = {
                "doc_id": part.column(0),
                "text_hash": part.column(2),
                "k1": pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                "k2": pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digests], pa.int64()),
                "size": pa.array(sizes, pa.int64()),
                "sketch": pa.array([x.tobytes() for x in sketch], pa.binary()),
            }
            for level in range(1, DEPTH + 1):
                steps = chosen(flat, sizes, runs, level, threshold)
                columns[f"level{level}"] = pa.array(steps, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)
        give_back()

    return run


def _places(row: Column | np.ndarray):
    """The two places of a row hash in the filter."""
    if isinstance(row, np.ndarray):
        bits = row.view(np.uint64)
        return [(bits >> np.uint64(s)) & np.uint64(FILTER_BITS - 1) for s in (0, 32)]
    return [F.shiftrightunsigned(row, s).bitwiseAND(FILTER_BITS - 1) for s in (0, 32)]


def _tokens(docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """(row, tokens): the sets of the documents whose row hash is in ``rows``, made again.

    A filter of fixed size marks the rows wanted; others that pass it find no partner later.
    """
    at = F.explode(F.array(*_places(F.col("row"))))
    marked = (
        rows.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / 32).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(at % 32))")).alias("bits"))
        .toPandas()
    )  # at most FILTER_BITS / 32 rows
    words_of = np.zeros(FILTER_BITS // 32, np.uint32)
    words_of[marked["word"].to_numpy(int)] = marked["bits"].to_numpy(np.int64).astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(words_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.ones(batch.num_rows, bool)
            for place in _places(batch.column(1).to_numpy(zero_copy_only=False)):
                wanted &= (shared.value[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & 1 > 0
            for part in _parts(iter([batch.filter(pa.array(wanted))]), 0):
                sets = [s.astype(_TOKENS).tobytes() for s in shingle_sets(part.column(0), words)]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(sets, pa.binary())], ["row", "tokens"])
        give_back()

    found = docs.select("text", F.xxhash64("doc_id", F.xxhash64("text")).alias("row")).mapInArrow(run, "row long, tokens binary")
    return found.dropDuplicates(["row"])


def _by_group(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``column``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(column).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(group, group[-1], "left"))  # where the last, open group begins
        if held and held[-1].column(column)[0].as_py() != group[0]:
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` places is connected to by the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _compared(threshold: float):
    """Brute force in nodes: which sets hang together by their sketches."""
    least = math.ceil(SKETCH * threshold - MARGIN * math.sqrt(SKETCH * threshold * (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_group(batches, "node"):
            node = table.column("node").to_numpy()
            size = table.column("size").to_numpy()
            uid = table.column("uid").to_numpy()
            raw = table.column("sketch").combine_chunks()
            raw = pa.concat_arrays(raw.chunks) if isinstance(raw, pa.ChunkedArray) else raw
            sketch = np.frombuffer(b"".join(raw.to_pylist()), np.uint16).reshape(-1, SKETCH)
            first, second = [], []
            active = np.arange(len(node))
            for step in range(1, len(node)):
                active = active[active < len(node) - step]
                active = active[node[active] == node[active + step]]
                if not len(active):
                    break
                low, high = np.minimum(size[active], size[active + step]), np.maximum(size[active], size[active + step])
                near = active[low >= threshold * high - 1e-9]
                for at in range(0, len(near), 65536):
                    some = near[at : at + 65536]
                    hits = some[(sketch[some] == sketch[some + step]).sum(1) >= least]
                    first.append(hits)
                    second.append(hits + step)
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (first, second))
            label = uid[_labels(len(node), a, b)]
            found = label != uid
            yield pa.RecordBatch.from_arrays([pa.array(uid[found]), pa.array(label[found])], ["u", "v"])

    return run


def _verified(threshold: float):
    """Exact links in blocks: per set the linked sets and documents, and what it hangs on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_group(batches, "block"):
            out = []
            block = table.column("block").to_numpy()
            uid, part = table.column("uid").to_numpy(), table.column("part").to_numpy()
            copies, size = table.column("copies").to_numpy(), table.column("size").to_numpy()
            tokens = table.column("tokens")
            cuts = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
            for a, b in zip(cuts, [*cuts[1:], len(block)]):
                shared = _intersections([np.frombuffer(tokens[i].as_py(), _TOKENS) for i in range(a, b)])
                union = size[a:b, None] + size[None, a:b] - shared
                linked = shared >= threshold * union - 1e-9
                parts = part[a:b]
                if parts.any():  # two different blocks: only pairs across
                    linked &= parts[:, None] != parts[None, :]
                np.fill_diagonal(linked, False)
                x, y = np.nonzero(linked)
                label = uid[a:b][_labels(b - a, x, y)]
                out.append((uid[a:b], linked.sum(1), linked @ copies[a:b], label))
            if out:
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
                keep = columns[1] > 0
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["uid", "texts", "documents", "label"])
        give_back()

    return run


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    token, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    often = times[column] > 1
    place = np.cumsum(times > 1) - 1
    row, column = row[often], place[column[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((n, n), np.float32)
    width = max(256, 20_000_000 // max(1, n))
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        if a == b:
            continue
        part = np.zeros((n, column[b - 1] - low + 1), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        shared += part @ part.T
    return shared.astype(np.int64)


def candidate_groups(distinct: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, component) of the ``distinct`` sets that hang together by some node of the paths."""
    entries = distinct.select("uid", F.explode("level1").alias("node"))
    edges = []
    for level in range(1, DEPTH + 1):
        counts = entries.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = stored(entries.join(counts, "node"))
        most = SPLIT if level < DEPTH else BLOCK
        edges.append(_in_nodes(met.where(F.col("n") <= most).select("uid", "node"), distinct, threshold))
        rest = met.where(F.col("n") > most)
        if rest.isEmpty():
            break
        if level < DEPTH:
            entries = stored(_split(rest, distinct, level + 1))
        else:
            edges.append(_in_nodes(_blocks(rest), distinct, threshold))
    return connected_components(stored(reduce(DataFrame.unionByName, edges).distinct()))


def _in_nodes(entries: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    sketched = entries.join(distinct.select("uid", "size", "sketch"), "uid")
    dealt = sketched.select("node", "uid", "size", "sketch").repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(_compared(threshold), "u long, v long")


def _blocks(entries: DataFrame) -> DataFrame:
    """Entries of nodes too large for one task, dealt to nodes for each two of their blocks."""
    count = F.ceil(F.col("n") / (BLOCK // 2)).cast("int")
    pair = entries.withColumn("own", F.pmod(F.xxhash64("uid"), count).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), count - 1))
    )
    node = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return pair.select("uid", node.alias("node"))


def _split(entries: DataFrame, distinct: DataFrame, level: int) -> DataFrame:
    """The entries of large nodes, sent on to the nodes below by the tokens of their run."""
    run = F.lit((1 << RUN_BITS) - 1).cast("long")
    steps = distinct.select("uid", F.col(f"level{level}").alias("steps"))
    own = F.filter("steps", lambda t: t.bitwiseAND(run) == F.col("node").bitwiseAND(run))
    below = entries.join(steps, "uid").select("uid", "node", F.explode(own).alias("step"))
    node = F.xxhash64("node", "step").bitwiseAND(F.bitwise_not(run)).bitwiseOR(F.col("node").bitwiseAND(run))
    return below.select("uid", node.alias("node"))


def join(
    docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its class and its number of links.

    Two documents are linked if the Jaccard similarity of their shingle sets is at least
    ``threshold``. ``class_id`` is the smallest doc_id connected to the row by links (its own
    without any; null ids do not count); ``n_links`` counts the other rows linked to it, copies
    included, ``n_linked_texts`` the other shingle sets. ``kept`` marks one row of each class,
    with its smallest doc_id; ``text_hash`` is the xxhash64 of its text. Texts without words
    (null, empty) are linked to nothing and kept, a text of fewer words than a shingle is one
    shingle; repeated rows are copies of each other; other columns are ignored.
    """
    runs = runs_for(recall)
    if runs > 1 << RUN_BITS:
        raise ValueError(f"recall {recall} needs {runs} runs, more than {1 << RUN_BITS}")
    hashed = document_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")))
    prepared = hashed.mapInArrow(_prepared(words, threshold, runs), _PREPARED)
    sets = stored(prepared.withColumn("uid", F.monotonically_increasing_id()))
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("uid").alias("row"), "text_hash")
    levels = [f"level{i}" for i in range(1, DEPTH + 1)]
    distinct = stored(
        sets.where("size > 0").groupBy("k1", "k2").agg(
            F.min("uid").alias("uid"),
            F.min(least).alias("least"),
            F.count(F.lit(1)).alias("copies"),
            *[F.first(c).alias(c) for c in ("size", "sketch", *levels)],
        )
    )
    groups = stored(candidate_groups(distinct, threshold))
    named_row = F.xxhash64("least.doc_id", "least.text_hash").alias("row")
    member = groups.join(distinct.select(F.col("uid").alias("node"), "size", "copies", named_row), "node")
    totals = member.groupBy("component").agg(F.sum("size").alias("t"), F.count(F.lit(1)).alias("m"))
    blocks = F.greatest(F.ceil(F.col("t") / BLOCK_TOKENS), F.ceil(F.col("m") / BLOCK_SETS)).cast("int")
    own, other = F.col("own"), F.col("other")
    placed = stored(
        member.join(totals.withColumn("blocks", blocks), "component")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
            F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("part"),
            F.col("node").alias("uid"),
            "copies",
            "size",
            "row",
        )
    )
    gathered = placed.join(_tokens(docs, placed.select("row").distinct(), words), "row")
    links = stored(
        gathered.select("block", "part", "uid", "copies", "size", "tokens")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_verified(threshold), "uid long, texts long, documents long, label long")
    )
    degrees = links.groupBy("uid").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    classes = connected_components(links.select(F.col("uid").alias("u"), F.col("label").alias("v")))
    known = distinct.select("k1", "k2", "uid", "least", "copies")
    named = known.join(classes.withColumnRenamed("node", "uid"), "uid", "left").join(degrees, "uid", "left")
    of_all = named.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("of_class"))
    of_class = F.coalesce("of_class", "least")
    result = named.join(of_all, "component", "left").select(
        "k1",
        "k2",
        of_class["doc_id"].alias("class_id"),
        of_class["row"].alias("kept_row"),
        (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_linked_texts"),
    )
    rows = sets.select("doc_id", "text_hash", "size", "k1", "k2", "uid")
    some = rows.where("size > 0").join(result, ["k1", "k2"])
    none = rows.where("size = 0").select(
        "*",
        F.col("doc_id").alias("class_id"),
        F.col("uid").alias("kept_row"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_links", "n_linked_texts")],
    )
    return some.unionByName(none).select(
        "doc_id", "class_id", "n_links", "n_linked_texts", (F.col("uid") == F.col("kept_row")).alias("kept"), "text_hash"
    )


def distinct_documents(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` of which one document of each class of ``join`` stays.

    All columns are kept. Rows equal in doc_id and text count as one.
    """
    kept = join(docs, threshold, words).where("kept").select(F.col("doc_id").alias("kept_id"), "text_hash")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (rows["text_hash"] == kept["text_hash"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "text_hash"]).select("doc.*")
