"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph is hashed to a wide vector of integers and a document's fingerprint is the sum
of its paragraphs' vectors modulo a power of two. Sums do not depend on order, and paragraphs
are inserted or deleted by adding or subtracting their vectors (``combine``).

A vector has two parts. The exact part holds ``EXACT`` lanes hashed from the paragraph itself;
equal multisets of paragraphs give equal lanes. The likeness part holds ``LANES`` counters: of
each pair of neighbouring words in the paragraph, lane j counts whether bit j of its hash is
set. Read as sums of +1 and -1, these lanes have an inner product that estimates the number of
word pairs that two documents share, which gives ``likeness``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import partitions

#: Lanes of 32 bits hashed from the paragraph.
EXACT = 8
#: Counters of 31 bits, two to a number.
LANES = 64
#: The counters are kept modulo 2**31, the exact lanes modulo 2**32.
_COUNT, _WORD = (1 << 31) - 1, (1 << 32) - 1
#: Slices of neighbouring ids for each partition, so that partitions are even.
SLICES_PER_PARTITION = 4

_PACKED = [f"c{j}" for j in range(LANES // 2)]
_HASHED = [f"e{j}" for j in range(EXACT)]
_VECTOR = ["pairs", *_HASHED, *_PACKED]


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text: its lines that hold more than white space, trimmed."""
    return F.filter(
        F.transform(F.split(text, r"\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))),
        lambda p: p != "",
    )


def _units(text: Column) -> Column:
    """What is hashed: (true, hash) of each paragraph, (false, hash) of each word pair in it."""

    def of(paragraph: Column) -> Column:
        words = F.split(paragraph, " ")
        pairs = F.zip_with(
            F.concat(F.array(F.lit("")), F.slice(words, 1, F.size(words) - 1)),
            words,
            lambda a, b: F.struct(F.lit(False).alias("whole"), F.xxhash64(a, b).alias("h")),
        )
        whole = F.array(F.struct(F.lit(True).alias("whole"), F.xxhash64(paragraph).alias("h")))
        return F.concat(whole, pairs)

    return F.flatten(F.transform(paragraphs(text), of))


def _sums() -> list[Column]:
    """One sum for each number of a vector over the units of a text; nulls count as none."""
    h = F.col("unit.h")
    whole = F.coalesce(F.col("unit.whole"), F.lit(False))
    pair = ~F.coalesce(F.col("unit.whole"), F.lit(True))
    sums = [F.sum(F.when(pair, 1).otherwise(0)).alias("pairs")]
    for j, name in enumerate(_HASHED):
        lane = F.xxhash64(h, F.lit(j)).bitwiseAND(_WORD)
        sums.append(F.sum(F.when(whole, lane).otherwise(0)).bitwiseAND(_WORD).alias(name))
    for j, name in enumerate(_PACKED):
        low = F.shiftrightunsigned(h, j).bitwiseAND(1)
        high = F.shiftleft(F.shiftrightunsigned(h, j + LANES // 2).bitwiseAND(1), 31)
        sums.append(F.sum(F.when(pair, low.bitwiseOR(high)).otherwise(0)).alias(name))
    return sums


def sketches(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key`` and ``vector`` (pairs, exact lanes, packed counters) of every row of ``texts``.

    ``key`` must identify a row. A null or blank text has the zero vector.
    """
    units = texts.select(*key, F.explode_outer(_units(F.col(text))).alias("unit"))
    return units.groupBy(*key).agg(*_sums()).select(
        *key, F.array(*[F.col(c) for c in _VECTOR]).alias("vector")
    )


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Vector of the paragraphs of both (sign 1), or of ``a`` without those of ``b`` (-1)."""
    added = F.zip_with(a, b, lambda x, y: x + sign * y)
    return F.transform(
        added,
        lambda x, i: F.when((i >= 1) & (i <= EXACT), x.bitwiseAND(_WORD)).otherwise(x),
    )


def fingerprint(vector: Column) -> Column:
    """The vector as a string: equal for equal multisets of paragraphs."""
    return F.concat(
        *[F.lpad(F.lower(F.hex(vector[i])), 8, "0") for i in range(1, EXACT + 1)],
        F.lit("-"),
        F.array_join(F.transform(F.slice(vector, EXACT + 2, LANES // 2), lambda x: F.lower(F.hex(x))), "."),
    )


def _inner(a: Column, b: Column) -> Column:
    """Inner product of the counters of two vectors, read as sums of +1 and -1."""

    def signed(vector: Column, packed: Column, shift: int) -> Column:
        count = F.shiftrightunsigned(packed, shift).bitwiseAND(_COUNT)
        return (2 * count - vector[0]).cast("double")

    products = [
        signed(a, a[1 + EXACT + j], s) * signed(b, b[1 + EXACT + j], s)
        for j in range(LANES // 2)
        for s in (0, 31)
    ]
    return reduce(lambda x, y: x + y, products)


def likeness(a: Column, b: Column, aa: Column, bb: Column) -> Column:
    """Estimated cosine of the word-pair counts of two vectors, from 0 to 1; ``aa`` and ``bb``
    are their own inner products. 1 for equal vectors, 0 if just one is empty."""
    cosine = _inner(a, b) / F.sqrt(aa * bb)
    return F.when(a == b, 1.0).when((aa > 0) & (bb > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine))).otherwise(0.0)


def with_next(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) in descending doc_id order, each row with the next row's text.

    Rows are dealt once, into slices of neighbouring ids; the first row of a slice is dealt to
    the slice before it as well (``ghost``), the very first one to the last slice. Columns:
    slice, seq (place in the slice), ghost, doc_id, text, next_text. Equal ids follow each
    other in the order of their texts, null ids come last. The slice bounds are ids at equal
    steps through the table, a list as long as the number of slices.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = slices or SLICES_PER_PARTITION * partitions(docs.sparkSession)
    steps = [(i + 1) / count for i in range(count)]
    cut = docs.agg(
        F.percentile_approx("doc_id", steps, 10 * count).alias("at"), F.max("doc_id").alias("top")
    ).first()
    bounds = sorted({*(cut["at"] or [])[:-1]} - {cut["top"]}) + ([cut["top"]] if cut["top"] is not None else [])
    if not bounds:
        return _lead(docs.select(F.lit(0).alias("slice"), F.lit(False).alias("ghost"), "*"), 1)
    at = F.array(*[F.lit(b).cast("long") for b in bounds])
    # null ids: slice 0, the lowest; the bound of a slice is its highest id
    own = F.coalesce(F.size(F.filter(at, lambda b: b < F.col("doc_id"))), F.lit(0))
    edge = F.coalesce(F.array_contains(at, F.col("doc_id")), F.lit(False))
    last = len(bounds)
    places = F.when(
        edge,
        F.array(
            F.struct(own.alias("slice"), F.lit(False).alias("ghost")),
            F.struct(((own + 1) % last).alias("slice"), F.lit(True).alias("ghost")),
        ),
    ).otherwise(F.array(F.struct(own.alias("slice"), F.lit(False).alias("ghost"))))
    return _lead(docs.select(F.inline(places), "doc_id", "text"), last)


def _lead(dealt: DataFrame, slices: int) -> DataFrame:
    order = W.partitionBy("slice").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    first = F.first("text").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    following = F.lead("text").over(order)
    if slices == 1:  # a table without ids, or with one: its first row follows its last
        following = F.coalesce(following, first)
    return dealt.select(
        "slice",
        F.row_number().over(order).alias("seq"),
        "ghost",
        "doc_id",
        "text",
        following.alias("next_text"),
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text) and of its edited text.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Texts are dealt out once, into slices of neighbouring ids; all later steps stay
    in those slices. A null text counts as empty; a blank text has the zero fingerprint, and
    two blank texts are alike (1). Repeated rows each get a row, the next document of a row
    may be its copy; the only row of a table follows itself. Other columns are ignored.
    """
    row = with_next(docs).withColumn("edited", edited(F.col("text"), F.coalesce("next_text", F.lit(""))))
    carried = F.struct(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.when(~F.col("ghost"), F.sha2(F.encode("edited", "UTF-8"), 256)).alias("edited_sha256"),
    )
    both = row.select(
        "slice", "seq", "ghost", carried.alias("doc"),
        F.explode(
            F.when(F.col("ghost"), F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("of"))))
            .otherwise(
                F.array(
                    F.struct(F.lit(0).alias("side"), F.col("text").alias("of")),
                    F.struct(F.lit(1).alias("side"), F.col("edited").alias("of")),
                )
            )
        ).alias("v"),
    )
    flat = both.select("slice", "seq", "ghost", "doc", F.col("v.side").alias("side"), F.col("v.of").alias("of"))
    vectors = sketches(flat, ["slice", "seq", "ghost", "doc", "side"], "of")
    vectors = vectors.withColumn("own", _inner(F.col("vector"), F.col("vector")))
    # text, edited text, next text, ...: the edited text is the next row, the next text the one after
    order = W.partitionBy("slice").orderBy("seq", "side")
    value = F.struct("vector", "own")
    lined = vectors.select("*", F.lead(value, 1).over(order).alias("e"), F.lead(value, 2).over(order).alias("n"))
    mine = lined.where((F.col("side") == 0) & ~F.col("ghost"))
    # only in a table of one slice without a ghost row does the last row have none after it
    first = F.first(F.when(F.col("side") == 0, value), ignorenulls=True).over(W.partitionBy("slice").orderBy("seq"))
    mine = mine.select("*", F.coalesce("n", first).alias("next"))
    a, e, n = F.col("vector"), F.col("e.vector"), F.col("next.vector")
    return mine.select(
        "doc.doc_id",
        "doc.n_chars",
        "doc.edited_sha256",
        fingerprint(a).alias("fingerprint"),
        fingerprint(e).alias("edited_fingerprint"),
        likeness(a, e, F.col("own"), F.col("e.own")).alias("near_edited"),
        likeness(a, n, F.col("own"), F.col("next.own")).alias("near_next"),
    )
