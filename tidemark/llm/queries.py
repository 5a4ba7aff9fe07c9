"""Registered queries of this subpackage and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, fingerprints, jaccard_join, language, mixing, neighbours, periodic, secrets, token_counts, top_k, toxicity, url_filter, whitening
from tidemark.llm.common import drop_tables, held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Vocabulary of the encoder.
VOCABULARY = "word_bpe_49k.json"
#: Ranks of the tokens of flat files, and their end-of-document identifier.
TOKEN_RANKS, END_OF_TEXT = "byte_bpe_50k.tiktoken", 50256
ALLOWED = [("org", "/"), ("com", "/fr/")]
BLOCKED = [("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/")]


clean_up = drop_tables


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


#: Domain of each source; others are in the domain "other".
DOMAINS = {f"src{i}": d for d, ids in {"crawl": [0], "books": range(1, 7), "code": range(7, 13), "forum": range(13, 18)}.items() for i in ids}
#: Target weights of domains and of their languages; sources weigh the same but for one.
WEIGHTS = (
    {("crawl",): 0.3, ("books",): 0.35, ("code",): 0.15, ("forum",): 0.1, ("other",): 0.1}
    | {(d, lang): w for d in ("crawl", "books", "code", "forum", "other") for lang, w in (("en", 0.4), ("de", 0.3), ("fr", 0.2), ("es", 0.1))}
    | {("books", "en", "src1"): 3.0}
)
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 2, 20


def mix_levels() -> list[str | Column]:
    names = F.create_map(*[F.lit(x) for pair in DOMAINS.items() for x in pair])
    return [F.coalesce(names[F.col("source")], F.lit("other")), "lang", "source"]


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mix = mixing.Mix(docs, mix_levels(), WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mix.select(docs).select(
        "doc_id", mix_levels()[0].alias("domain"), "lang", "source", "epoch", "n_tokens", "take_tokens"
    )


def _mixing_sql() -> str:
    """The same shares by window sums, the prefixes by a running sum over each leaf."""
    cols = ["l0", "l1", "l2"]

    def case(path: str, names: dict, default: str) -> str:
        when = " ".join(f"WHEN '{k}' THEN {v}" for k, v in names.items())
        return f"CASE {path} {when} ELSE {default} END"

    ctes = [
        f"""docs AS MATERIALIZED (SELECT doc_id, lang, source,
              {case("source", {k: f"'{v}'" for k, v in DOMAINS.items()}, "'other'")} AS l0,
              coalesce(lang, 'none') AS l1, coalesce(source, 'none') AS l2,
              len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+')) AS n FROM documents)""",
        "leaf AS (SELECT l0, l1, l2, sum(n) AS tokens FROM docs GROUP BY ALL)",
    ]
    below = f"(SELECT *, tokens * {float(MIX_EPOCHS)} AS holds FROM leaf)"
    for level in (3, 2, 1):
        at = ", ".join(cols[:level])
        named = {"|".join(k): w for k, w in WEIGHTS.items() if len(k) == level}
        weight = case(f"concat_ws('|', {at})", named, "1.0")
        ctes.append(f"""h{level} AS MATERIALIZED (SELECT {at}, CAST(sum(holds) AS DOUBLE) AS holds, CAST({weight} AS DOUBLE) AS weight
              FROM {below} GROUP BY {at} HAVING sum(holds) > 0 AND CAST({weight} AS DOUBLE) > 0)""")
        below = f"h{level}"
    ctes.append(f"g0 AS (SELECT least((SELECT floor({MIX_SHARE} * sum(tokens)) FROM leaf), (SELECT sum(holds) FROM h1)) AS given)")
    for level in (1, 2, 3):
        up, at = cols[: level - 1], cols[:level]
        join = f"JOIN g{level - 1} u USING ({', '.join(up)})" if up else "CROSS JOIN g0 u"
        by = f"PARTITION BY {', '.join(up)}" if up else ""
        ctes.append(f"""m{level} AS (SELECT h.*, u.given AS budget,
              coalesce(sum(holds) OVER ({by} ORDER BY holds / weight, {', '.join(at)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + holds / weight * sum(weight) OVER ({by} ORDER BY holds / weight, {', '.join(at)} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
              <= u.given AS whole FROM h{level} h {join})""")
        ctes.append(f"""g{level} AS (SELECT {', '.join(at)}, least(holds, CASE WHEN whole THEN holds ELSE
              (budget - sum(CASE WHEN whole THEN holds ELSE 0 END) OVER ({by})) * weight
              / sum(CASE WHEN whole THEN 0 ELSE weight END) OVER ({by}) END) AS given FROM m{level})""")
    return f"""WITH {', '.join(ctes)},
      plan AS (SELECT l0, l1, l2, CAST(floor(given + 1e-6) AS BIGINT) AS b, tokens FROM g3 JOIN leaf USING (l0, l1, l2)),
      part AS (SELECT *, CAST(b // tokens AS INTEGER) AS passes, b % tokens AS remain FROM plan),
      every AS (SELECT d.*, p.*, CAST(e AS INTEGER) AS epoch,
                md5(concat('{MIX_SEED}:', e, ':', coalesce(CAST(doc_id AS VARCHAR), ''))) AS o
                FROM docs d JOIN part p USING (l0, l1, l2), range({MIX_EPOCHS}) r(e) WHERE e <= passes),
      placed AS (SELECT *, sum(n) OVER (PARTITION BY l0, l1, l2, epoch ORDER BY o ROWS UNBOUNDED PRECEDING) - n AS before FROM every)
      SELECT doc_id, l0 AS domain, lang, source, epoch, n AS n_tokens,
             CAST(CASE WHEN epoch < passes THEN n ELSE least(n, remain - before) END AS BIGINT) AS take_tokens
      FROM placed WHERE epoch < passes OR before < remain"""


ORACLE["op1_mixing"] = _mixing_sql()


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path(TOKEN_RANKS)
    files, manifest = token_counts.write_flat(docs, ranks, public_tokenizers.PATTERN, END_OF_TEXT)
    counts = token_counts.scan(files, END_OF_TEXT)
    return counts.join(manifest, ["file", "ordinal"], "left").select(
        "doc_id", "file", "ordinal", "first_token", "n_tokens", "terminated"
    )


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(~held_out()))
    return language.identify(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~held_out()))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.neighbours(vectors, vectors.where("vec_id % 20 = 0"))


ORACLE["op6_neighbours"] = """
WITH usable AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 20
"""


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_filter.rule_table(spark, ALLOWED, BLOCKED)
    return url_filter.judge(
        pages, rules, url_filter.html_links(pages), url_filter.spelling_links(pages)
    )


#: Rules by host suffix and path prefix, aliases by the closure of the links.
ORACLE["op7_url_filter"] = r"""
WITH RECURSIVE rules(h, p, verdict) AS (VALUES {rules}
), split AS MATERIALIZED (
  SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), tags AS (
  SELECT url, regexp_extract(url, '^[^:]*://[^/?#]*') AS site, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM split
), links AS (
  SELECT url AS u, site, CASE
      WHEN regexp_matches(tag, '(?i)\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
      WHEN regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) END AS t
  FROM tags
), edges AS MATERIALIZED (
  SELECT u, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
      WHEN starts_with(t, '//') THEN regexp_extract(u, '^[^:]*:') || t WHEN starts_with(t, '/') THEN site || t
      WHEN regexp_matches(t, '^[?#]') THEN regexp_extract(u, '^[^?#]*') || t ELSE regexp_extract(u, '^[^?#]*/') || t END AS v
  FROM links WHERE t <> ''
  UNION
  SELECT url, 'https://' || translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '(?:\.html?|/+)$', '')
      || CASE WHEN q <> '' THEN '?' || q ELSE '' END
  FROM (SELECT *, array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(?:utm_[a-z]+|ref|fbclid|gclid)=')), '&') AS q FROM split WHERE rest IS NOT NULL)
), urls AS MATERIALIZED (
  SELECT DISTINCT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
        FROM (SELECT url FROM split UNION SELECT u FROM edges UNION SELECT v FROM edges) WHERE url IS NOT NULL)
), matched AS MATERIALIZED (
  SELECT url, h || p AS rule, verdict FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(h || p) DESC, length(h) DESC, verdict) = 1
), both_ways AS MATERIALIZED (
  SELECT u, v FROM edges WHERE u <> v UNION SELECT v, u FROM edges WHERE u <> v
), reach AS (
  SELECT u AS x, u AS y FROM both_ways UNION SELECT r.x, b.v FROM reach r JOIN both_ways b ON r.y = b.u
), shared AS (
  SELECT x, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM reach JOIN matched ON y = url GROUP BY x
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, m.rule,
       coalesce(m.verdict, s.verdict, 'allow') AS verdict, CASE WHEN m.rule IS NULL THEN s.verdict END AS from_aliases
FROM split LEFT JOIN urls USING (url) LEFT JOIN matched m USING (url) LEFT JOIN shared s ON s.x = split.url
""".replace("{rules}", ", ".join(f"('{h}', '{p}', '{v}')" for v, rules in (("allow", ALLOWED), ("block", BLOCKED)) for h, p in rules))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = jaccard_join.join(table(spark, sf_dir, "documents"))
    return links.select("doc_id", "class_id", "n_links", "n_linked_texts")


#: Links of all pairs of documents that share a shingle, and their connected components.
ORACLE["op8_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT x, y, c = p.n AND c = q.n AS same
  FROM shared JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 10 * c >= 8 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), sets AS MATERIALIZED (  -- the least document of each set of equal shingles
  SELECT d.doc_id, least(d.doc_id, coalesce(min(l.y) FILTER (l.same), d.doc_id)) AS s
  FROM documents d LEFT JOIN links l ON l.x = d.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, (SELECT min(y) FROM reach WHERE reach.x = d.doc_id) AS class_id,
       count(l.y) AS n_links,
       count(DISTINCT s.s) FILTER (NOT l.same) AS n_linked_texts
FROM documents d LEFT JOIN links l ON l.x = d.doc_id LEFT JOIN sets s ON s.doc_id = l.y
GROUP BY d.doc_id
"""


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.scan(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return spans.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(F.encode(secrets.spans_text(of(*secrets.BASE)), "UTF-8"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def _secrets_sql() -> str:
    """Matches and the gaps between them give the positions; parts meet by their distance."""
    keyword = "(?i:(?:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?)"
    name = "(?i:\\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)[\"'']?\\x20*[:=]\\x20*[\"'']?)"
    schemes = "https?|ftps?|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp"
    mixed = "regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')"
    kinds = [
        ("assign", keyword + "[A-Za-z0-9+/_.=-]+", "secret", True, f"length(regexp_replace(hit, '^{keyword}', '')) >= 12"),
        ("access", "AKIA[A-Z0-9]{14,}", "identifier", True, "true"),
        ("hex", "[0-9a-f]{16,}", "secret", True, "true"),
        ("name", name + "[A-Za-z0-9._@+-]{3,}", "identifier", False, "true"),
        ("blob", "[A-Za-z0-9+/_-]{20,}={0,2}", "secret", False, mixed),
        ("endpoint", f"\\b(?:{schemes})://[^\\s\"''<>]+", "endpoint", False, "true"),
    ]
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, {i} AS ord, '{kind}' AS kind, '{role}' AS role, {strong} AS strong, e - length(hit) AS s, e
        FROM (SELECT doc_id, hits[i] AS hit, list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                + list_sum(list_transform(hits[1:i], lambda h: length(h))) AS e
          FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS gaps FROM documents)))
        WHERE {kept}"""
        for i, (kind, pattern, role, strong, kept) in enumerate(kinds)
    )
    has = ", ".join(f"bool_or(o.role = '{r}') AS {r}" for r in ("identifier", "secret", "endpoint"))
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord)"
    return f"""WITH parts AS MATERIALIZED ({parts}),
      met AS (SELECT w.doc_id, w.ord, w.kind, w.role, w.s, w.e, {has}, bool_or(o.strong AND o.s <= w.s AND o.e >= w.e) AS inside
        FROM parts w JOIN parts o ON w.doc_id = o.doc_id AND o.s <= w.e + {secrets.REACH} AND o.e >= w.s - {secrets.REACH}
        WHERE NOT w.strong GROUP BY ALL),
      spans AS (SELECT doc_id, ord, kind, s, e FROM parts WHERE strong UNION ALL SELECT doc_id, ord, kind, s, e FROM met
        WHERE CASE role WHEN 'identifier' THEN secret WHEN 'secret' THEN (identifier OR endpoint) AND NOT inside ELSE identifier AND secret END)
      SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)},
        sha256(coalesce({listed} FILTER (ord < 3), '')) AS base_sha256, coalesce({listed}, '') AS spans
      FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


ORACLE["op9_secrets"] = _secrets_sql()


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the token ids of ``docs`` (doc_id, text) and of what they decode to."""
    return bpe.encode(docs.select("doc_id", "text"), path, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of all documents, chosen by a hash of their ids, is changed so that
    their words repeat from some word on."""
    words = F.filter(F.split("text", periodic.BLANKS), lambda w: w != "")
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10).cast("long")
    cut = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words").cast("long")
    cut = cut.withColumn("a", F.when(n > 0, F.pmod("g", n)))
    cut = cut.withColumn("p", F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    repeated = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.repeated_runs(with_repeats(table(spark, sf_dir, "documents")))
    longest = periodic.longest_run(F.col("runs"))
    return found.select("doc_id", "runs", "collapsed", longest.alias("top")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.encode(periodic.runs_text(F.col("runs")), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


#: Pairs of equal words at most a quarter of the text apart, and the islands of their places.
ORACLE["op11_periodic_runs"] = r"""
WITH cyclic AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), source AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM documents, cyclic
), placed AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM source
), words AS MATERIALIZED (
  SELECT row, n, i, w[1 + CASE WHEN i < a OR a IS NULL THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END] AS word
  FROM placed, unnest(range(n)) AS r(i)
), pairs AS (
  SELECT l.row, l.i, r.i - l.i AS p FROM words l JOIN words r ON l.row = r.row AND l.word = r.word AND r.i > l.i AND 4 * (r.i - l.i) <= l.n
), islands AS (
  SELECT row, p, min(i) AS s, count(*) + p AS len FROM (
    SELECT row, p, i, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS island FROM pairs)
  GROUP BY row, p, island HAVING count(*) + p >= greatest(6, 4 * p)
), runs AS MATERIALIZED (
  SELECT row, s, len, min(p) AS q FROM islands GROUP BY ALL
), counted AS (
  SELECT row, count(*) AS n_runs, first(struct_pack(s := s, len := len, q := q) ORDER BY len DESC, s, q) AS top,
    string_agg(concat(s, ',', len, ',', q, chr(10)), '' ORDER BY s, q) AS listed FROM runs GROUP BY row
), gone AS (
  SELECT DISTINCT row, i FROM runs, unnest(range(s + q, s + len)) AS r(i)
), left_over AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (row, i) GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.len AS length, top.q AS period, 1000 * top.len // top.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM source LEFT JOIN counted USING (row) LEFT JOIN left_over USING (row)
"""


@query
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("long"))
    vectors = table(spark, sf_dir, "embeddings").where(top_k.finite(F.col("embedding"))).select("vec_id", whole.alias("vector"))
    return top_k.top_k(vectors, vectors.where("vec_id % 20 = 0"))


ORACLE["op12_exact_top_k"] = """
WITH usable AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    vectors = table(spark, sf_dir, "embeddings").where(top_k.finite(F.col("embedding")))
    return whitening.whiten(vectors.select("vec_id", whole.alias("vector")))
