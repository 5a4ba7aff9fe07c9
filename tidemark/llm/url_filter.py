"""URL filter with redirect equivalence.

Rules decide the addresses they fit. Redirects and canonical links make addresses aliases of
each other; a decision spreads over the connected component of aliases, and an explicit allow
in a component takes precedence over its blocks. Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import connected_components, stored

#: A rule list of at most this many rows is broadcast.
BROADCAST_RULES = 100_000
#: Query parameters that only track where a visit came from.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(
    spark: SparkSession, allow: list[tuple[str, str]], block: list[tuple[str, str]]
) -> DataFrame:
    """Rules (host, path, verdict) from two lists of (host, path)."""
    rows = [(h, p, "allow") for h, p in allow] + [(h, p, "block") for h, p in block]
    cells = [
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
        for h, p, v in rows
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule that fits each of ``urls`` (distinct ``url``): url, rule, verdict.

    A rule fits its host and all subdomains of it when the path starts with the rule's path.
    Each address meets the rules through equi-joins only: on the suffixes of its host, then
    on (host, prefix of the path) for the prefix lengths that occur with that host. Of rules
    of equal length the one with the longer host wins, then allow.
    """
    small = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda df: df)
    rules = rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict")
    ).where("r_host IS NOT NULL AND r_path IS NOT NULL AND verdict IS NOT NULL")
    lengths = rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fits = (
        urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .where("host <> ''")
        .select("url", "path", F.explode(suffixes).alias("r_host"))
        .join(hint(lengths), "r_host")
        .select("url", "path", "r_host", F.explode("lengths").alias("n"))
        .where(F.col("n") <= F.length("path"))
        .select("url", "r_host", F.substring("path", F.lit(1), F.col("n")).alias("r_path"))
        .join(hint(rules), ["r_host", "r_path"])
    )
    rank = F.struct(
        F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("verdict") == "allow"
    )
    best = F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "verdict"), rank)
    return fits.groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.verdict")


def html_links(pages: DataFrame) -> DataFrame:
    """Edges (u, v) from a page's url to its canonical link and to its refresh target."""
    tags = F.regexp_extract_all(F.col("html"), F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))
    found = pages.where("url IS NOT NULL AND html IS NOT NULL").select(
        "url", F.explode(tags).alias("tag")
    )
    canonical = F.col("tag").rlike(r"(?i)\brel\s*=\s*[\"']?canonical\b")
    refresh = F.col("tag").rlike(r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b")
    href = F.regexp_extract("tag", r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    target = F.regexp_extract("tag", r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1)
    to = F.when(canonical, href).when(refresh, target)
    site = F.regexp_extract("url", r"^[^:]*://[^/?#]*", 0)
    whole = (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.startswith("//"), F.concat(F.regexp_extract("url", r"^[^:]*:", 0), to))
        .when(to.startswith("/"), F.concat(site, to))
        .when(to.rlike(r"^[?#]"), F.concat(F.regexp_extract("url", r"^[^?#]*", 0), to))
        .otherwise(F.concat(F.regexp_extract("url", r"^[^?#]*/", 0), to))
    )
    return found.where(canonical | refresh).where(to != "").select(
        F.col("url").alias("u"), whole.alias("v")
    )


def spelling_links(pages: DataFrame) -> DataFrame:
    """Edges (u, v) from a url to the plain spelling servers redirect it to: https, lower-case
    host, no fragment, tracking parameter, ``.html`` or slash at the end."""
    url = F.col("url")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(
        F.filter(F.split(query, "&"), lambda p: ~p.rlike(rf"(?i)^{TRACKING}=") & (p != "")), "&"
    )
    path = F.regexp_replace(path_of(url), r"(?:\.html?|/+)$", "")
    plain = F.concat(
        F.lit("https://"),
        host_of(url),
        path,
        F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
    )
    return pages.where(F.instr(url, "://") > 0).select(url.alias("u"), plain.alias("v"))


def judge(pages: DataFrame, rules: DataFrame, *links: DataFrame) -> DataFrame:
    """Every row of ``pages`` (page_id, url) with host, path, ``rule`` and ``verdict``.

    ``links`` hold edges (u, v) between addresses. A page that a rule fits keeps that rule's
    verdict. Any other page takes the verdict of its aliases: allow if a rule allows one of
    them, else block if a rule blocks one, else allow. A null url, or one without ``://``,
    has an empty host and path, no rule and the verdict allow; repeated rows and repeated
    urls are judged alike; empty pages or rules give no rows or no rules. Other columns of
    ``pages`` are ignored.
    """
    edges = stored(reduce(DataFrame.unionByName, links).where("u <> v").distinct())
    ends = edges.select(F.col("u").alias("url")).unionByName(edges.select(F.col("v").alias("url")))
    urls = pages.select("url").unionByName(ends).where("url IS NOT NULL").distinct()
    matched = stored(match_rules(urls, rules))
    members = stored(connected_components(edges))
    decided = (
        members.join(matched, members["node"] == matched["url"])
        .groupBy("component")
        .agg(F.max(F.col("verdict") == "allow").alias("allowed"))
    )
    spread = members.join(decided, "component").select(
        F.col("node").alias("url"), F.when(F.col("allowed"), "allow").otherwise("block").alias("shared")
    )
    verdicts = matched.join(spread, "url", "full").select(
        "url", "rule", F.coalesce("verdict", "shared").alias("verdict"), "shared"
    )
    return pages.select("page_id", "url").join(verdicts, "url", "left").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("shared")).alias("from_aliases"),
    )
