"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

Only DataFrame functions; rules may be any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import written

#: Rules of the registered query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; '' without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _prefix(expression: Column, digits: int) -> Column:
    return F.substring(F.sha2(expression, 256), 1, digits)


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", digits: int = 8) -> DataFrame:
    """(host, path, rule, verdict) of every distinct host and path that a rule fits.

    Each host and path is expanded into host suffixes x path prefixes (of the
    lengths that rule paths have, so a URL has a bounded number). Expressions
    meet rules on the first ``digits`` hex digits of their SHA-256; the full
    digest then confirms. The longest rule wins, then the longer host, then
    ``block`` before ``allow``.
    """
    rules = rules.select(F.translate(F.col("host"), _UPPER, _LOWER).alias("r_host"),
                         F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")) \
        .where("r_host is not null and r_path is not null and r_verdict is not null")
    # distinct lengths of rule paths: bounded by the longest rule path, not by the rules
    lengths = sorted(r[0] for r in rules.select(F.length("r_path")).distinct().collect())
    rules = rules.withColumn("rule", F.concat("r_host", "r_path")) \
        .withColumn("digest", F.sha2("rule", 256)) \
        .withColumn("short", F.substring("digest", 1, digits))

    u = F.col(url)
    pairs = urls.select(host_of(u).alias("host"), path_of(u).alias("path")).distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]) if lengths else F.expr("array()").cast("array<int>"),
                       lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.col("path").substr(F.lit(1), n))
    expressions = pairs.select("host", "path", F.explode(suffixes).alias("suffix")) \
        .select("host", "path", "suffix", F.explode(prefixes).alias("prefix")) \
        .select("host", "path", F.concat("suffix", "prefix").alias("expression")) \
        .select("host", "path", F.sha2("expression", 256).alias("full"),
                _prefix(F.col("expression"), digits).alias("short"))
    found = expressions.join(rules, "short").where(F.col("full") == F.col("digest"))
    order = F.struct(F.length("rule"), F.length("r_host"), (F.col("r_verdict") == "block").cast("int"),
                     F.col("rule"), F.col("r_verdict"))
    return found.groupBy("host", "path").agg(F.max(order).alias("best")) \
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.r_verdict").alias("verdict"))


def url_filter(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """One row (key, host, path, rule, verdict) per row of ``pages``.

    Null URLs and those without ``://`` have empty host and path and get
    ``default``, as does every URL that no rule fits (rule null). Repeated rows
    are each judged; null keys stay; other columns of ``pages`` are not read.
    The matches are a written table, so a hot URL's rows can be split by AQE.
    """
    judged = written(judge(pages, rules, url), "url-rules")
    u = F.col(url)
    rows = pages.select(F.col(key).alias("k"), host_of(u).alias("host"), path_of(u).alias("path"))
    return rows.join(judged, ["host", "path"], "left").select(
        F.col("k").alias(key), "host", "path", "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))


ORACLE = r"""
WITH u AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
    arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) d
  JOIN r ON (d.host = r_host OR ends_with(d.host, '.' || r_host)) AND starts_with(d.path, r_path)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.host = m.host AND p.path = m.path
"""
