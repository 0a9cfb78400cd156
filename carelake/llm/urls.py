"""Block and allow decisions for URLs, carried to aliases over redirect and canonical-link edges.

A URL's node is its host and path. A page links its own node to the target of `<link rel="canonical">` and of a
`<meta http-equiv="refresh">`; connected components of these links are sets of aliases. The decision of a page is
that of its own longest rule. Without a rule it takes what its aliases' rules say: allow if any alias is allowed
explicitly, else block if any is blocked, else allow.

Null URLs and URLs without "://" have an empty host and path, fit no rule and take part in no link. Repeated rows are
decided alike, each in its own row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, connected_components

#: (verdict, rule): host, then path, split at the first slash.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

REST = r"(?s)^.*?://(.*)$"
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = (r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)"
           r"[^>]*\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*'?([^\"'>\s]+)")


def host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), REST, 1)
    return F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), REST, 1)
    return F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [(v, r, r.partition("/")[0], "/" + r.partition("/")[2]) for v, r in rules]
    return spark.createDataFrame(rows, "verdict string, rule string, rule_host string, rule_path string")


def ruled(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """`nodes` (distinct host, path) that a rule fits, with the longest one.

    Every host is looked up under itself and each of its parent domains, an equality join however many rules there are.
    """
    labels = F.split("host", r"\.")
    n = F.size(labels)
    above = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    looked = nodes.where("host <> ''").withColumn("rule_host", F.explode(above))
    fits = looked.join(rules, "rule_host").where(F.startswith("path", "rule_path"))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def links(pages: DataFrame) -> DataFrame:
    """Edges (`a`, `b`) between nodes: from a page to what it names as canonical or redirects to.

    A target without "://" is taken relative to the page: `//host/path`, `/path` or a name beside the page.
    """
    source = pages.select("url", "html").where(
        F.col("html").isNotNull() & F.col("html").rlike(r"(?i)canonical|refresh"))
    targets = source.select("url", F.explode(F.array(
        F.regexp_extract("html", CANONICAL, 1), F.regexp_extract("html", REFRESH, 1))).alias("to")).where("`to` <> ''")
    own = targets.select("to", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    to = F.col("to")
    there = (F.when(to.contains("://"), to)
             .when(to.startswith("//"), F.concat(F.lit("x:"), to))
             .when(to.startswith("/"), F.concat(F.lit("x://"), F.col("host"), to))
             .otherwise(F.concat(F.lit("x://"), F.col("host"), F.regexp_extract("path", r"(?s)^(.*/)", 1), to)))
    rows = own.where("host <> ''").select(
        F.struct("host", "path").alias("a"), F.struct(host(there).alias("host"), path(there).alias("path")).alias("b"))
    return rows.where("b.host <> '' and a <> b").distinct()


def decided(pages: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """Every page with host, path, its rule, and the verdict of the rule or of its aliases."""
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    edges = scratch.keep(links(pages), "links")
    groups = connected_components(edges, scratch)
    ends = groups.select("node.host", "node.path")
    known = scratch.keep(ruled(rows.select("host", "path").union(ends).distinct(), rules), "ruled")
    groups = groups.select("node.host", "node.path", F.col("component").alias("component"))
    said = groups.join(known, ["host", "path"]).groupBy("component").agg(
        F.max(F.col("verdict") == "allow").alias("allowed"))
    taken = groups.join(said, "component").select(
        "host", "path", F.when(F.col("allowed"), "allow").otherwise("block").alias("said"))
    # Both sides grow with the pages; small files would pass for a side to broadcast.
    out = rows.join(known.hint("merge"), ["host", "path"], "left").join(taken.hint("merge"), ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("verdict", "said", F.lit("allow")).alias("verdict"))


#: The same by SQL: rules by comparison, links by recursion from the nodes that a rule decides.
SQL = r"""
WITH RECURSIVE rules(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'),
  ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')),
r AS (SELECT verdict, rule, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM rules),
p AS (
  SELECT page_id, html,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)),
x AS (
  SELECT host, path, unnest([
    regexp_extract(html, '(?is)<link\s[^>]*rel\s*=\s*["'']?canonical["'']?[^>]*href\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(html, '(?is)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh["'']?[^>]*url\s*=\s*([^"''>\s]+)', 1)]) AS dest
  FROM p WHERE host <> ''),
y AS (SELECT host, path, substr(dest, strpos(dest, '://') + 3) AS rest FROM x WHERE strpos(dest, '://') > 0),
e AS (
  SELECT host, path, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host2,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path2 FROM y),
b AS (SELECT * FROM e UNION SELECT host2, path2, host, path FROM e),
n AS (SELECT host, path FROM p UNION SELECT host2, path2 FROM e),
k AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM n JOIN r ON host <> '' AND (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path),
w(host, path, verdict) AS (
  SELECT host, path, verdict FROM k
  UNION SELECT b.host2, b.path2, w.verdict FROM w JOIN b ON w.host = b.host AND w.path = b.path),
s AS (SELECT host, path, min(verdict) AS said FROM w GROUP BY host, path)
SELECT page_id, p.host, p.path, k.rule, coalesce(k.verdict, s.said, 'allow') AS verdict
FROM p LEFT JOIN k ON p.host = k.host AND p.path = k.path LEFT JOIN s ON p.host = s.host AND p.path = s.path
"""
