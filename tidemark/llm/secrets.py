"""Secret scan with multipart credential linking, in SQL functions only.

Base patterns are reported wherever they stand. Weak parts (a user or key name, a bare random
token, an endpoint, a match too short for a base pattern) are reported only where complementary
parts of a credential stand within reach of each other, which an interval join finds, or in one
block of settings (lines of keys and values, JSON), however long.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F


class Kind(NamedTuple):
    name: str
    pattern: str
    role: str
    strong: bool
    at_least: int = 0  # of the value, for patterns that end in one


_ASSIGN = (
    r"(?i:(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)[A-Za-z0-9+/_.=-]+"
)
_VALUE = r"^(?i:(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)"

#: In the order in which kinds of one start are listed. A run of 16 or more hex digits, or of
#: 18 or more characters from AKIA on, is the whole match of the open-ended pattern; for the
#: assignments the short values must be matched first and become weak parts later.
KINDS = (
    Kind("assign", _ASSIGN, "secret", True, 12),
    Kind("access", r"AKIA[A-Z0-9]{14,}", "identifier", True),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", "secret", True),
    Kind(
        "name",
        r"(?i:\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?)"
        r"[A-Za-z0-9._@+-]{3,}",
        "identifier",
        False,
    ),
    Kind(
        "blob",
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
        r"[A-Za-z0-9+/_-]{20,}={0,2}",
        "secret",
        False,
    ),
    Kind(
        "endpoint",
        r"\b(?:https?|ftps?|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+",
        "endpoint",
        False,
    ),
    Kind("short_access", r"AKIA[A-Z0-9]{1,13}(?![A-Z0-9])", "identifier", False),
    Kind("short_hex", r"(?<![A-Za-z0-9+/_.-])[0-9a-f]{8,15}(?![A-Za-z0-9+/_-])", "secret", False),
    # not a part: runs of lines that begin with a key and its sign, or hold brackets only
    Kind(
        "block",
        r"(?m)(?:^[\x20\t]*+(?:[{\[,\x20\t-]*+(?:export\x20)?[\"']?[\w.$-]++[\"']?[\x20\t]*+[:=][^\n]*+"
        r"|[\]\[{}(),;\x20\t]*+[\]\[{}][\]\[{}(),;\x20\t]*+$)\n?+)++",
        "block",
        False,
    ),
)
#: What an assignment whose value is too short for the base pattern is.
SHORT = Kind("short_assign", "", "secret", False)
BASE = ("assign", "access", "hex")
#: Code points between two parts outside of blocks that may belong to one credential.
REACH = 200


def _found(text: Column, kind: Kind) -> Column:
    """(gap before, length, kept) of each leftmost non-overlapping match, in order."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    whole = F.zip_with(
        hits,
        F.slice(gaps, 1, F.size(hits)),
        lambda hit, gap: F.struct(
            F.length(gap).cast("long").alias("gap"),
            F.length(hit).cast("long").alias("size"),
            (
                F.length(F.regexp_replace(hit, _VALUE, "")) >= kind.at_least
                if kind.at_least
                else F.lit(True)
            ).alias("kept"),
        ),
    )
    return F.when(text.rlike(kind.pattern), whole)


def find_parts(docs: DataFrame, key: list[str]) -> DataFrame:
    """Every match in ``text``: key, ord, kind, role, strong, start, end (code points).

    ``key`` tells rows apart by their content; rows equal in it count once.
    """
    lists = F.array(
        *[F.struct(F.lit(i).alias("ord"), _found(F.col("text"), k).alias("hits")) for i, k in enumerate(KINDS)]
    )
    some = F.filter(lists, lambda x: x["hits"].isNotNull())
    per_doc = docs.select(*key, some.alias("lists")).where(F.size("lists") > 0)
    once = per_doc.groupBy(*key).agg(F.first("lists").alias("lists"))
    hits = once.select(*key, F.inline("lists")).select(
        *key, "ord", F.posexplode("hits").alias("pos", "hit")
    )
    so_far = W.partitionBy(*key, "ord").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    ends = hits.withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.size")).over(so_far))
    ends = ends.withColumn("ord", F.when(F.col("hit.kept"), F.col("ord")).otherwise(len(KINDS)))
    names, roles, strong = (
        F.array(*[F.lit(v) for v in column])
        for column in zip(*[(k.name, k.role, k.strong) for k in (*KINDS, SHORT)])
    )
    return ends.select(
        *key,
        "ord",
        names[F.col("ord")].alias("kind"),
        roles[F.col("ord")].alias("role"),
        strong[F.col("ord")].alias("strong"),
        (F.col("end") - F.col("hit.size")).alias("start"),
        "end",
    )


def link_parts(parts: DataFrame, key: list[str], reach: int = REACH) -> DataFrame:
    """The weak ``parts`` that belong to a credential, by an interval join within the scope.

    Two parts meet if at most ``reach`` code points lie between them, or in a block. An identifier
    needs a secret, a secret an identifier or an endpoint, an endpoint both others. A bare token
    inside a base match is not reported again, a short match not inside any other part. Parts
    outside of blocks meet in bins of ``reach`` characters, so
    a bin holds few parts however many a document has.
    """
    def bins(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach)))

    roles = ("identifier", "secret", "endpoint")
    # blocks do not overlap, so the last one that began is the only one a part can be in
    so_far = W.partitionBy(*key).orderBy("start", F.col("role") != "block").rowsBetween(W.unboundedPreceding, 0)
    is_block = F.col("role") == "block"
    placed = parts.withColumn("block", F.max(F.when(is_block, F.col("start"))).over(so_far)).withColumn(
        "until", F.max(F.when(is_block, F.col("end"))).over(so_far)
    )
    placed = placed.withColumn("block", F.when(F.col("end") <= F.col("until"), F.col("block"))).where(~is_block)
    together = W.partitionBy(*key, "block")
    for r in roles:
        within = F.col("block").isNotNull() & F.max(F.col("role") == r).over(together)
        placed = placed.withColumn(f"with_{r}", within)
    parts = placed
    weak = parts.where(~F.col("strong")).select(
        *key, "ord", "kind", "role", "start", "end", *[f"with_{r}" for r in roles],
        bins(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach).alias("bin"),
    )
    near = parts.select(
        *key,
        bins(F.col("start"), F.col("end")).alias("bin"),
        F.col("ord").alias("o_ord"),
        F.col("role").alias("o_role"),
        F.col("strong").alias("o_strong"),
        F.col("start").alias("o_start"),
        F.col("end").alias("o_end"),
    )
    meet = weak.join(near, [*key, "bin"]).where(
        (F.col("o_start") <= F.col("end") + reach) & (F.col("o_end") >= F.col("start") - reach)
    )
    short = F.col("kind").startswith("short_")
    inside = (F.col("o_strong") | (short & (F.col("o_ord") != F.col("ord")))) & (F.col("o_start") <= F.col("start")) & (F.col("o_end") >= F.col("end"))
    seen = meet.groupBy(*key, "ord", "kind", "role", "start", "end").agg(
        *[F.max((F.col("o_role") == r) | F.col(f"with_{r}")).alias(f"has_{r}") for r in roles],
        F.max(inside).alias("inside"),
    )
    complete = (
        F.when(F.col("role") == "identifier", F.col("has_secret") & ~(short & F.col("inside")))
        .when(F.col("role") == "secret", (F.col("has_identifier") | F.col("has_endpoint")) & ~F.col("inside"))
        .otherwise(F.col("has_identifier") & F.col("has_secret"))
    )
    return seen.where(complete).select(*key, "ord", "kind", "role", "start", "end")


def _key(text: Column) -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64(text), F.length(text))


def span_rows(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_key, start, ord, kind, end) of every span of ``docs`` (doc_key, text)."""
    key = ["doc_key"]
    parts = find_parts(docs, key)
    columns = [*key, "start", "ord", "kind", "end"]
    return parts.where("strong").select(columns).unionByName(link_parts(parts, key, reach).select(columns))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with ``spans``, an array of (start, ord, kind, end).

    Offsets are code points, the end exclusive; spans are sorted by start, then kind. A null
    text counts as empty; an empty text has no spans; rows with equal doc_id and text get
    equal spans, also when doc_id is null. Texts are searched whole. Other columns of
    ``docs`` are ignored.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("doc_key", _key(F.col("text")))
    listed = span_rows(docs, reach).groupBy("doc_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "ord", "kind", "end"))).alias("spans")
    )
    empty = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>")
    joined = docs.select("doc_id", "doc_key").join(listed, "doc_key", "left")
    return joined.select("doc_id", F.coalesce("spans", empty).alias("spans"))


def redact(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets, overlapping spans
    by the first one's; all columns are kept. Only documents with a match are moved."""
    matches = F.lit(False)
    for kind in (k for k in KINDS if k.role != "block"):
        matches = matches | F.col("text").rlike(kind.pattern)
    matches = F.coalesce(matches, F.lit(False))
    some = docs.where(matches).select(F.struct("*").alias("doc"), "doc_id", "text")
    some = some.withColumn("doc_key", _key(F.col("text")))
    order = W.partitionBy("doc_key").orderBy("start", "ord")
    reached = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.coalesce(F.col("start") >= reached, F.lit(True)), 1).otherwise(0)
    runs = (
        span_rows(some.select("doc_key", "text"), reach)
        .withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(order))
        .groupBy("doc_key", "run")
        .agg(F.min("start").alias("a"), F.max("end").alias("b"), F.min_by("kind", F.struct("start", "ord")).alias("kind"))
        .groupBy("doc_key")
        .agg(F.array_sort(F.collect_list(F.struct("a", "b", "kind"))).alias("runs"))
    )

    def piece(run: Column, i: Column) -> Column:
        # from the end of the run before (0 for the first) to the start of this one
        before = F.when(i > 0, F.get(F.col("runs"), i - 1)["b"]).otherwise(0)
        gap = F.substring(F.col("text"), before.cast("int") + 1, (run["a"] - before).cast("int"))
        return F.concat(gap, F.lit("["), run["kind"], F.lit("]"))

    rest = F.substring(F.col("text"), F.element_at("runs", -1)["b"].cast("int") + 1, F.length("text"))
    clean = F.concat(F.array_join(F.transform("runs", piece), ""), rest)
    joined = some.join(runs, "doc_key", "left").withColumn("clean", F.coalesce(clean, F.col("text")))
    columns = [F.col("clean").alias("text") if c == "text" else F.col(f"doc.{c}") for c in docs.columns]
    return docs.where(~matches).unionByName(joined.select(columns))


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
