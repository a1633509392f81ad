"""Operator 9, URL filters: host-suffix and path-prefix expressions joined with rules on short hash prefixes.

Each distinct (host, path) is expanded into expressions ``suffix + path prefix`` as a hash-prefix lookup service does;
host suffixes are taken with as many labels, and path prefixes at the lengths, as the rules have, so an expression is
never longer than a rule and a host of a thousand labels costs no more than a short one.  The 32-bit head of an expression's SHA-256 is the join
key; the full digest confirms a hit, and the longest rule wins.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (action, host, path) in the order of their statement.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Rules of at most this number are broadcast; more are joined by a shuffle on the hash prefix.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules with the digest of ``host + path`` and its 8-digit head."""
    df = spark.createDataFrame(rules, "action string, rule_host string, rule_path string")
    return df.select(
        "action", F.concat("rule_host", "rule_path").alias("rule"),
        F.sha2(F.concat("rule_host", "rule_path"), 256).alias("rule_digest"),
    ).withColumn("head", F.substring("rule_digest", 1, 8))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule text wins (block
    before allow between rules of one text).  Where none fits, rule is null and the verdict is ``default``.  Null and
    empty URLs, and those without ``://``, have empty host and path and fit no rule.  Every row stays, repeated ones
    too; columns of the input that are named host, path, rule or verdict are replaced.  Rows without a host are joined
    with nothing, each under a key of its own; a URL that many rows share is judged once, and the join back is a plain
    sort-merge join, which Spark splits at a hot key (``spark.sql.adaptive.skewJoin.enabled``).
    """
    spark = pages.sparkSession
    ours = ["host", "path", "rule", "verdict"]
    others = [c for c in pages.columns if c not in ours]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(None))
    named = pages.select(row.alias("row"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    lengths = sorted({len(p) for _, _, p in rules})
    # the last n labels begin after the n-th dot from the end; a host with fewer labels than n is its own suffix once
    counts = sorted({h.count(".") + 1 for _, h, _ in rules})
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in counts])) if counts else F.array().cast("array<string>")
    prefixes = F.array_distinct(F.array(*[F.substring("path", 1, n) for n in lengths])) if lengths else F.array().cast("array<string>")
    distinct = named.where("host <> ''").groupBy("host", "path").agg(F.lit(1).alias("one"))
    expanded = (
        distinct.select("host", "path", F.explode(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))).alias("expression"))
        .withColumn("digest", F.sha2("expression", 256)).withColumn("head", F.substring("digest", 1, 8))
    )
    table = rule_table(spark, rules)
    hits = expanded.join(F.broadcast(table) if len(rules) <= BROADCAST_RULES else table, "head").where("digest = rule_digest")
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), F.struct(F.length("rule"), F.col("action"))).alias("best"), F.least(F.count("*"), F.lit(-1)).alias("none"))
    # -1, from the data, so that it stays a join key
    best = best.select(F.col("host").alias("best_host"), F.col("path").alias("best_path"), "none", "best")
    named = named.withColumn("own", F.when(F.col("host") == "", F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    return named.join(best, (F.col("host") == F.col("best_host")) & (F.col("path") == F.col("best_path")) & (F.col("own") == F.col("none")), "left").select(
        *[F.col("row").getField(c).alias(c) for c in others], "host", "path",
        F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), rules(action, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM hp JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT hp.page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM hp LEFT JOIN best USING (page_id)
"""
