"""URL filter lists.

A rule is a host and a path; it fits its host and every subdomain when the
URL's path starts with the rule's path.  Each URL is expanded into host-suffix
x path-prefix expressions (only prefix lengths that some rule has), the
expressions meet the rules in an equi-join on a short hash prefix, full digests
confirm a meeting, and the longest rule wins.

Precedence among the rules that fit: longest host+path text, then longest host,
then block before allow, then the smaller text.  URLs no rule fits get
``default``.

The join runs once per distinct (host, path), so a URL or host that holds a
third of all rows is expanded and joined once.  The rules are broadcast only
while they are under ``max_broadcast_rules``; a larger list is joined by
shuffle on the hash prefix, with distinct expressions.

Cases: a null URL or one without ``://`` has an empty host and path; an empty
path fits only rules with an empty path; a rule with a null host or path is
ignored; equal rules count once; an empty rule list gives ``default``
everywhere; repeated rows get equal rows; result columns replace input columns
of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import free_name, quoted, read_table

PREFIX_HEX = 8
MAX_BROADCAST_RULES = 100_000
RULE_SCHEMA = "rule_verdict string, rule_host string, rule_path string"

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Text behind the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lowered; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and every parent domain: a.b.c, b.c, c (the empty host for the empty host)."""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def expressions(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Host-suffix x path-prefix expressions, as host NUL path; prefixes only of lengths that rules have."""
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    prefixes = F.transform(sizes, lambda n: F.substring(path, F.lit(1), n))
    return F.array_distinct(
        F.flatten(F.transform(host_suffixes(host), lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit("\0"), p))))
    )


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with their expression, digest, hash prefix and rank of precedence."""
    expr = F.concat("host", F.lit("\0"), "path")
    return (
        rules.select(lower_ascii(F.col("rule_host")).alias("host"), F.col("rule_path").alias("path"), F.col("rule_verdict").alias("says"))
        .where("host IS NOT NULL AND path IS NOT NULL AND says IS NOT NULL")
        .distinct()
        .withColumn("digest", F.sha2(expr, 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
        .withColumn(
            "rank",
            F.struct(
                (F.length("host") + F.length("path")).alias("n"),
                F.length("host").alias("h"),
                F.when(F.col("says") == "block", 1).otherwise(0).alias("b"),
            ),
        )
    )


def filter_urls(
    df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", max_broadcast_rules: int = MAX_BROADCAST_RULES
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host+path of the winner, else null) and ``verdict`` to every row."""
    ready = prepared_rules(rules).persist()
    try:
        # A path-length set and a count: both bounded by the longest rule and one number.
        lengths = sorted(r["n"] for r in ready.select(F.length("path").alias("n")).distinct().collect())
        small = ready.limit(max_broadcast_rules + 1).count() <= max_broadcast_rules
    finally:
        ready.unpersist()
    ready = prepared_rules(rules)
    if small:
        ready = F.broadcast(ready)
    # Names of our own that no input column has.
    host, path, rule, says = (free_name(n, df.columns) for n in ("_host", "_path", "_rule", "_says"))
    rows = df.select(*[quoted(c) for c in df.columns if c not in ("host", "path", "rule", "verdict") or c == url_col])
    rows = rows.withColumns({host: host_of(quoted(url_col)), path: path_of(quoted(url_col))})
    if not lengths:
        judged = rows.withColumns({rule: F.lit(None).cast("string"), says: F.lit(None).cast("string")})
    else:
        places = rows.select(F.col(host).alias("_host"), F.col(path).alias("_path")).distinct()
        expanded = places.select("_host", "_path", F.explode(expressions(F.col("_host"), F.col("_path"), lengths)).alias("_expr"))
        expanded = expanded.withColumn("_digest", F.sha2("_expr", 256)).withColumn("_short", F.substring("_digest", 1, PREFIX_HEX))
        if small:
            met = expanded.join(ready, F.col("_short") == F.col("short")).where(F.col("_digest") == F.col("digest"))
        else:
            # Shared expressions (a whole domain, the root path) meet the rules once.
            distinct = expanded.select("_expr", "_digest", "_short").distinct()
            found = distinct.join(ready, F.col("_short") == F.col("short")).where(F.col("_digest") == F.col("digest"))
            met = expanded.select("_host", "_path", "_expr").join(found.drop("_short", "_digest"), "_expr")
        winner = met.groupBy("_host", "_path").agg(
            F.max(
                F.struct(
                    "rank.n",
                    "rank.h",
                    "rank.b",
                    F.concat("host", "path").alias("text"),
                    F.col("says"),
                )
            ).alias("w")
        )
        verdicts = winner.select(F.col("_host").alias(host), F.col("_path").alias(path), F.col("w.text").alias(rule), F.col("w.says").alias(says))
        judged = rows.join(verdicts, [host, path], "left")
    keep = [quoted(c) for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    return judged.select(
        *keep,
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        F.col(rule).alias("rule"),
        F.coalesce(F.col(says), F.lit(default)).alias("verdict"),
    )


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(RULES), RULE_SCHEMA)
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(says, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, host, path, rhost || rpath AS rule, says, length(rhost || rpath) AS n FROM p LEFT JOIN r
  ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n DESC NULLS LAST) AS k FROM m) WHERE k = 1
"""
