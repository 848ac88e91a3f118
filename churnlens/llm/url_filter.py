"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Each distinct (host, path) is expanded into (host suffix, path prefix) expressions: the
suffixes with as many labels as some rule has, the prefixes as long as some rule's path.
Expressions meet rules by an equi-join on the first 32 bits of a digest; a hit counts
after the full digest agrees; the longest rule wins.

Defined results: a null url or one without ``://`` has an empty host and path, fits no
rule and gets the default verdict (allow); the same holds for an empty host; equal urls
are judged once and every page row gets its verdict; repeated page ids stay apart; equal
rules count once and a block goes before an allow of the same expression; of rules equally
long the one with the longer host wins; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common as C

#: The rules of the registered query, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
DEFAULT = "allow"
#: Hash prefixes are so many hex digits of the SHA-256 of an expression.
PREFIX_HEX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lower-cased; path: from
    there up to ? or # or the end."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = C.ascii_lower(F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0))
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """verdict, host, path -> the rules, one per expression, with digests and lengths."""
    df = spark.createDataFrame(rules, "verdict STRING, host STRING, path STRING")
    return prepared(df)


def prepared(rules: DataFrame) -> DataFrame:
    expr = F.concat("host", "path")
    return (rules.groupBy(expr.alias("rule"), "host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
            .select("rule", "verdict", F.sha2("rule", 256).alias("digest"), F.length("rule").alias("len"),
                    F.length("host").alias("host_len"), F.length("path").alias("path_len"),
                    F.size(F.split("host", r"\.")).alias("labels"))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url key columns (host, path, n) -> the same with rule and verdict (null: no rule).

    ``rules`` comes from ``prepared``; it is joined as Spark sees fit (its size decides
    between broadcast and shuffle). Only its distinct label counts and path lengths
    reach the driver: at most one value for each length a rule has.
    """
    sizes = rules.agg(F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("path_len")).alias("lens")).first()
    labels, lens = list(sizes["labels"]), list(sizes["lens"])
    host_labels = F.split("host", r"\.")
    ints = "array<int>"
    fits_host = F.filter(F.array(*[F.lit(x) for x in labels]).cast(ints), lambda k: k <= F.size(host_labels))
    fits_path = F.filter(F.array(*[F.lit(x) for x in lens]).cast(ints), lambda k: k <= F.length("path"))
    each = (urls.where(F.col("host") != "").withColumn("k", F.explode(fits_host)).withColumn("p", F.explode(fits_path))
            .withColumn("suffix", F.array_join(F.slice(host_labels, F.size(host_labels) - F.col("k") + 1, F.col("k")), "."))
            .withColumn("x", F.sha2(F.concat("suffix", F.substring(F.col("path"), F.lit(1), F.col("p"))), 256))
            .select("host", "path", "x", F.substring("x", 1, PREFIX_HEX).alias("prefix")))
    best = F.max(F.struct("len", "host_len", "rule", "verdict")).alias("best")
    hits = each.join(rules, "prefix").where(F.col("x") == F.col("digest")).groupBy("host", "path").agg(best)
    return hits.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Rows of ``pages`` (columns ``keep``) plus host, path, rule and verdict; the new
    columns' names by role. Frequent urls are judged once and joined back by
    ``common.attach``."""
    keep = pages.columns if keep is None else keep
    names = {k: C.internal(pages, k) for k in ("host", "path", "rule", "verdict", "digest")}
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias(names["host"]), path.alias(names["path"]))
    rows = rows.withColumn(names["digest"], F.sha2(F.concat(names["host"], names["path"]), 256))
    keys = rows.groupBy(F.col(names["digest"]).alias("digest"), F.col(names["host"]).alias("host"), F.col(names["path"]).alias("path")).agg(
        F.count(F.lit(1)).alias("n"))
    keys = cut_lineage(keys)
    # every url, ruled or not, so that frequent ones without a rule are marked too
    ruled = cut_lineage(keys.join(judge(keys.select("host", "path"), rules), ["host", "path"], "left").select(
        F.col("digest").alias(names["digest"]), "n", F.col("rule").alias(names["rule"]), F.col("verdict").alias(names["verdict"])))
    out = C.attach(rows, ruled, [names["digest"]], "n", [names["rule"], names["verdict"]], F.col(f"`{keep[0]}`") if keep else F.lit(0))
    return out.withColumn(names["verdict"], F.coalesce(names["verdict"], F.lit(DEFAULT))).drop(names["digest"]), names


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query: host, path, rule and verdict of every page."""
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url")
    out, n = filter_urls(pages, rule_table(spark, RULES), keep=["page_id"])
    return out.select("page_id", *[F.col(n[k]).alias(k) for k in ("host", "path", "rule", "verdict")])


SQL = r"""
WITH rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x FROM pages),
p AS (SELECT r, page_id, translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
hit AS (SELECT p.r, rules.host || rules.path AS rule, verdict FROM p, rules
        WHERE (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path)),
best AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM hit GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (r)
"""
