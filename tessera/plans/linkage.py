"""Record-linkage queries (scored pairs): parsing, class counts, missing-aware statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators import stats
from tessera.plans.views import with_views
from tessera.session import scratch_path
from tessera.sources import fixtures, text

N_SCORES = 9


def parsed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pair lines → header removed → typed pairs."""
    data, _ = text.split_header(fixtures.pair_lines(spark, sf))
    return text.parse_scored_pairs(data)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(
        "id1", "id2", *[X.round6(F.get(F.col("scores"), i)).alias(f"s{i}") for i in range(N_SCORES)], "matched"
    )


_FLAT_SQL = ", ".join(f"round(scores[{i + 1}], 6) AS s{i}" for i in range(N_SCORES))


def q_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pairs-text")
    text.write_lines(fixtures.pair_lines(spark, sf), path)
    data, _ = text.split_header(text.read_lines(spark, path))
    return _flat(text.parse_scored_pairs(data))


def q_header_split(spark: SparkSession, sf: str) -> DataFrame:
    lines = fixtures.pair_lines(spark, sf)
    return lines.groupBy(F.col("value").contains(text.HEADER_MARKER).alias("is_header")).agg(F.count(F.lit(1)).alias("lines"))


def q_pair_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(parsed_pairs(spark, sf))


def q_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.count_by(parsed_pairs(spark, sf), "matched")


def q_column_stats(spark: SparkSession, sf: str) -> DataFrame:
    p = parsed_pairs(spark, sf).select(*[F.get(F.col("scores"), i).alias(f"s{i}") for i in range(N_SCORES)])
    out = stats.column_stats(p, [f"s{i}" for i in range(N_SCORES)])
    return out.select("column", "count", "missing", *[X.round6(c).alias(c) for c in ["mean", "stdev", "min", "max"]])


def q_missing_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.missing_stats(parsed_pairs(spark, sf), "scores", width=N_SCORES, by=["matched"])
    return out.select("matched", "pos", "count", "missing", *[X.round6(c).alias(c) for c in ["mean", "stdev", "min", "max"]])


def q_feature_contrast(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.feature_contrast(parsed_pairs(spark, sf), "scores", "matched", N_SCORES)
    return out.select("pos", "missing", X.round6("mean_diff").alias("mean_diff"))


def q_pair_score(spark: SparkSession, sf: str) -> DataFrame:
    p = parsed_pairs(spark, sf)
    return p.select("id1", "id2", "matched", X.round6(stats.pair_score(p)).alias("score"))


def q_score_threshold(spark: SparkSession, sf: str) -> DataFrame:
    p = parsed_pairs(spark, sf)
    return stats.score_threshold(p.withColumn("score", stats.pair_score(p)), "score", "matched", (4.0, 2.0))


_STAT_SQL = """count({x}) AS count, count(*) - count({x}) AS missing, round(avg({x}), 6) AS mean,
  round(stddev_pop({x}), 6) AS stdev, round(min({x}), 6) AS min, round(max({x}), 6) AS max"""

_SCORE_SQL = "coalesce(scores[3], 0) + coalesce(scores[6], 0) + coalesce(scores[7], 0) + coalesce(scores[8], 0) + coalesce(scores[9], 0)"

SQL = {
    "text_roundtrip": with_views("pairs") + f"SELECT id1, id2, {_FLAT_SQL}, matched FROM pairs",
    "header_split": with_views("pairs")
    + "SELECT false AS is_header, count(*) AS lines FROM pairs UNION ALL SELECT true, CAST(1 AS BIGINT)",
    "pair_parse": with_views("pairs") + f"SELECT id1, id2, {_FLAT_SQL}, matched FROM pairs",
    "class_counts": with_views("pairs") + "SELECT matched, count(*) AS count FROM pairs GROUP BY matched",
    "column_stats": with_views("pairs")
    + "SELECT 's' || (p - 1) AS \"column\", "
    + _STAT_SQL.format(x="x")
    + " FROM (SELECT unnest(scores) AS x, unnest(generate_series(1, 9)) AS p FROM pairs) GROUP BY p",
    "missing_stats": with_views("pairs")
    + "SELECT matched, CAST(p - 1 AS INTEGER) AS pos, "
    + _STAT_SQL.format(x="x")
    + " FROM (SELECT matched, unnest(scores) AS x, unnest(generate_series(1, 9)) AS p FROM pairs) GROUP BY matched, p",
    "feature_contrast": with_views("pairs")
    + """SELECT CAST(p - 1 AS INTEGER) AS pos, count(*) - count(x) AS missing,
  round(avg(x) FILTER (WHERE matched) - avg(x) FILTER (WHERE NOT matched), 6) AS mean_diff
FROM (SELECT matched, unnest(scores) AS x, unnest(generate_series(1, 9)) AS p FROM pairs) GROUP BY p""",
    "pair_score": with_views("pairs") + f"SELECT id1, id2, matched, round({_SCORE_SQL}, 6) AS score FROM pairs",
    "score_threshold": with_views("pairs")
    + f"""SELECT t AS threshold, matched, count(*) AS count
FROM (SELECT matched, {_SCORE_SQL} AS score FROM pairs) CROSS JOIN (VALUES (4.0::DOUBLE), (2.0::DOUBLE)) v(t)
WHERE score >= t GROUP BY t, matched""",
}

QUERIES = {
    "text_roundtrip": q_text_roundtrip,
    "header_split": q_header_split,
    "pair_parse": q_pair_parse,
    "class_counts": q_class_counts,
    "column_stats": q_column_stats,
    "missing_stats": q_missing_stats,
    "feature_contrast": q_feature_contrast,
    "pair_score": q_pair_score,
    "score_threshold": q_score_threshold,
}
