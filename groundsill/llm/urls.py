"""URL filters: a blocked Bloom filter in front of an exact hash join, with built-in functions only.

Two lists decide about a URL. A rule names a host and the beginning of a path, and allows or
blocks all URLs of that host and its subdomains whose path begins so; the longest rule wins. A
list of canonical URLs blocks what it names; a rule goes before it.

A URL asks for a handful of keys: one for every pair of host suffix and path beginning that a
rule could name, and its own canonical form. Keys of both lists go into one blocked Bloom filter,
which has a fixed number of rows and is broadcast; URLs test their keys where they were read. Only
possible hits go on to the exact join, which removes false positives. Repeated URLs are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill.llm import bloom
from groundsill.llm.tables import free_name

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"^([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(
        url, F.instr(url, "://") + 3)), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), _SPLIT, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), _SPLIT, 2)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without slashes at its end, and the sorted query parts that are
    not ``utm_`` tracking; scheme and fragment do not count."""
    parts = F.array_sort(F.filter(
        F.split(F.regexp_extract(_rest(url), _SPLIT, 3), "&"),
        lambda p: (p != "") & ~p.startswith("utm_")))
    query = F.array_join(parts, "&")
    return F.concat(
        F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _rule_keys(host_col: Column, path_col: Column, lengths: list[int]) -> Column:
    """All rules that could fit: each host suffix with each beginning of the path that is as long
    as some rule's path."""
    labels = F.split(host_col, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    beginnings = F.filter(
        F.transform(F.array(*[F.lit(n) for n in lengths]),
                    lambda n: F.when(F.length(path_col) >= n, F.substr(path_col, F.lit(1), n))),
        lambda p: p.isNotNull())
    return F.flatten(F.transform(
        suffixes, lambda s: F.transform(beginnings, lambda p: F.concat(F.lit("r"), s, p))))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, url_col: str = "url",
          blocks: int = bloom.BLOCKS) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; columns of those names are replaced.

    ``rules`` has ``rule`` (host and path, like ``net/``) and ``verdict``; ``listed`` has the URLs
    to block in ``url``. Host and path are empty for a URL that is null or has no ``://``; such a
    URL fits no rule and no list. Equal rules with different verdicts block. An empty list blocks
    nothing.
    """
    ruled = rules.where("rule is not null").select(
        F.translate(F.regexp_extract("rule", r"^([^/]*)(.*)", 1), _UPPER, _LOWER).alias("h"),
        F.regexp_extract("rule", r"(?s)^([^/]*)(.*)", 2).alias("p"), "verdict")
    lengths = sorted(r.n for r in ruled.select(F.length("p").alias("n")).distinct().toLocalIterator())
    entries = ruled.select(
        F.concat(F.lit("r"), "h", "p").alias("key"), F.lit(1).alias("kind"),
        F.length(F.concat("h", "p")).alias("long"), F.concat("h", "p").alias("rule"), "verdict",
    ).unionByName(listed.where(host(F.col("url")) != "").select(
        F.concat(F.lit("u"), canonical(F.col("url"))).alias("key"), F.lit(0).alias("kind"),
        F.lit(0).alias("long"), F.lit(None).cast("string").alias("rule"),
        F.lit(BLOCK).alias("verdict"))).distinct()

    base = pages.drop("host", "path", "rule", "verdict")
    base = base.withColumns({"host": host(F.col(url_col)), "path": path(F.col(url_col))})
    urls = base.where(F.col("host") != "").select(F.col(url_col).alias("url"), "host", "path").distinct()
    own = F.array(F.concat(F.lit("u"), canonical(F.col("url"))))
    keys = F.concat(_rule_keys(F.col("host"), F.col("path"), lengths), own) if lengths else own
    asked = urls.select("url", F.explode(keys).alias("key"))
    built = bloom.build(entries, F.xxhash64("key"), blocks)
    hits = bloom.maybe_in(asked, F.xxhash64("key"), built, blocks).join(entries, "key")
    judged_url, best = free_name(base, "judged_url"), free_name(base, "best")
    judged = hits.groupBy(F.col("url").alias(judged_url)).agg(
        F.max(F.struct("kind", "long", "rule", "verdict")).alias(best))
    # URLs that are null match nothing and would all meet in one task; they go round the join.
    matched = base.where(F.col(url_col).isNotNull()).join(
        judged, F.col(url_col) == F.col(judged_url), "left").drop(judged_url)
    missing = base.where(F.col(url_col).isNull()).withColumn(
        best, F.lit(None).cast(judged.schema[best].dataType))
    return matched.unionByName(missing).withColumns({
        "rule": F.col(f"{best}.rule"),
        "verdict": F.coalesce(F.col(f"{best}.verdict"), F.lit(ALLOW))}).drop(best)


# The rules of the registered query, and words that mark a host as spam.
RULES = [("com/", ALLOW), ("example.com/en/", BLOCK), ("www.example.com/en/", ALLOW),
         ("net/es/", BLOCK), ("net/fr/", BLOCK)]
SPAM_HOSTS = ["spam-farm", "cheap-pills"]

SQL = """
WITH parsed AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(rest, ''), '^[^?#]*[?]([^#]*)', 1) AS query
  FROM parsed),
canon AS (
  SELECT *, regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(parts) = 0 THEN '' ELSE '?' || array_to_string(list_sort(parts), '&') END AS own
  FROM (SELECT *, list_filter(string_split(query, '&'),
      lambda p: p <> '' AND NOT starts_with(p, 'utm_')) AS parts FROM split)),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ranked AS (
  SELECT c.page_id, r.h || r.p AS rule, r.verdict,
    row_number() OVER (PARTITION BY c.page_id ORDER BY length(r.h || r.p) DESC) AS place
  FROM canon c JOIN rules r
    ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p)),
listed AS (
  SELECT DISTINCT own FROM canon WHERE host LIKE '%spam-farm%' OR host LIKE '%cheap-pills%')
SELECT c.page_id, c.host, c.path, r.rule,
  coalesce(r.verdict, CASE WHEN l.own IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c
LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON c.page_id = r.page_id
LEFT JOIN listed l ON c.own = l.own AND c.host <> ''"""
