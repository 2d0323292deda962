"""Recommender queries: rating and name parsing, aliases, splits, popularity, AUC and ALS."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators import evaluate, recommend, sampling, stats
from tessera.plans.views import with_views
from tessera.session import stored
from tessera.sources import fixtures, text

# Query parameters (a point lookup and one user's history are the feature of those queries).
USER_ID = 42
ITEM_ID = 42
LOOKUP_ID = 7
NAME_SUBSTRING = "red"
TOP_N = 5
SOME_USERS = 10
TRAIN_SHARE = 900  # of 1000 buckets


def parsed_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return text.parse_triples(fixtures.rating_lines(spark, sf))


def names(spark: SparkSession, sf: str) -> DataFrame:
    return text.parse_names_lenient(fixtures.item_lines(spark, sf))


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    return text.parse_aliases(fixtures.alias_lines(spark, sf), order_col="ord")


def all_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings with canonical item ids; k1/k2 key the split."""
    return recommend.canonical_ratings(fixtures.rating_rows(spark, sf), aliases(spark, sf))


def split(spark: SparkSession, sf: str, ratings: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    r = all_ratings(spark, sf) if ratings is None else ratings
    train, cv = sampling.hash_split(r, [0.9, 0.1], bucket=sampling.arithmetic_bucket("k1", "k2"))
    return train, cv


def kept_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """``all_ratings`` computed once, for queries that read it several times."""
    return stored(all_ratings(spark, sf), "ratings")


def q_ratings_parse(spark, sf):
    return parsed_ratings(spark, sf)


def q_id_stats(spark, sf):
    r = parsed_ratings(spark, sf).select(F.col("user").cast("double").alias("user"), F.col("item").cast("double").alias("item"))
    out = stats.column_stats(r, ["user", "item"])
    return out.select("column", "count", *[X.round6(c).alias(c) for c in ["mean", "stdev", "min", "max"]])


def q_name_parse_strict(spark, sf):
    return text.parse_names_strict(fixtures.item_lines(spark, sf, with_bad=False))


def q_name_parse_lenient(spark, sf):
    return names(spark, sf)


def q_alias_parse(spark, sf):
    return aliases(spark, sf)


def q_name_lookup(spark, sf):
    return names(spark, sf).filter(F.col("id") == LOOKUP_ID).limit(1)


def q_substring_filter(spark, sf):
    return fixtures.item_lines(spark, sf).filter(F.col("value").contains(NAME_SUBSTRING))


def q_preview(spark, sf):
    return fixtures.item_lines(spark, sf).orderBy("ord").limit(10)


def q_user_history(spark, sf):
    return parsed_ratings(spark, sf).filter(F.col("user") == USER_ID)


def q_id_count(spark, sf):
    return parsed_ratings(spark, sf).filter(F.col("item") == ITEM_ID).agg(F.count(F.lit(1)).alias("n"))


def q_history_names(spark, sf):
    mine = parsed_ratings(spark, sf).filter(F.col("user") == USER_ID).select(F.col("item").alias("id"))
    return names(spark, sf).join(mine, "id", "left_semi")


def q_ratings_canonical(spark, sf):
    return all_ratings(spark, sf).select("user", "item", "rating")


def q_distinct_items(spark, sf):
    return all_ratings(spark, sf).select("item").distinct()


def q_split_union(spark, sf):
    train, cv = split(spark, sf)
    return train.unionByName(cv).select("user", "item", "rating")


def q_hash_split(spark, sf):
    train, cv = split(spark, sf)
    parts = [train.withColumn("split", F.lit("train")), cv.withColumn("split", F.lit("cv"))]
    u = parts[0].unionByName(parts[1])
    return u.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user").alias("users"), F.sum("rating").alias("total_rating")
    )


def q_hash_sample(spark, sf):
    r = all_ratings(spark, sf)
    return sampling.hash_sample(r, 0.05, bucket=sampling.arithmetic_bucket("k1", "k2", seed=1)).select("user", "item", "rating", "k1", "k2")


def q_popularity(spark, sf):
    train, _ = split(spark, sf)
    return recommend.item_popularity(train)


def q_popularity_predict(spark, sf):
    train, cv = split(spark, sf)
    return recommend.popularity_predictor(train)(cv.select("user", "item"))


def q_top_n_popular(spark, sf):
    train, _ = split(spark, sf)
    pop = recommend.item_popularity(train)
    return pop.orderBy(F.col("popularity").desc(), "item").limit(TOP_N)


def q_user_top_items(spark, sf):
    r = all_ratings(spark, sf).groupBy("user", "item").agg(F.sum("rating").alias("total"))
    return recommend.top_n_by(r, ["user"], "total", 3, ["item"]).select("user", "item", "total", "rank")


def q_negative_samples(spark, sf):
    ratings = kept_ratings(spark, sf)
    _, cv = split(spark, sf, ratings)
    return sampling.negative_samples(cv.select("user", "item"), ratings.select("item"))


def _popularity_auc(spark, sf):
    ratings = kept_ratings(spark, sf)
    train, cv = split(spark, sf, ratings)
    pos = cv.select("user", "item")
    neg = sampling.negative_samples(pos, ratings.select("item"))
    return pos, neg.select("user", "item"), recommend.popularity_predictor(train)


def q_user_auc(spark, sf):
    out = evaluate.predicted_auc(*_popularity_auc(spark, sf))
    return out.select("user", X.round6("auc").alias("auc"), "n_pos", "n_neg")


def q_mean_auc(spark, sf):
    out = evaluate.mean_auc(*_popularity_auc(spark, sf))
    return out.select(X.round6("mean_auc").alias("mean_auc"), "users")


# ---- fitted models ----
# These return the fitted values.  SQL cannot repeat them: tests/test_recommend.py and tests/test_models.py
# hold a half-step against a plain solve and the rows against the data, and ``recommend_blocks`` holds
# the ranking of given factors against SQL.

ALS_SEED = 7


def _als(spark, sf, rank=10, max_iter=5, reg=0.01, alpha=1.0):
    train, cv = split(spark, sf, kept_ratings(spark, sf))
    return recommend.fit_als(train, rank, max_iter, reg, alpha, seed=ALS_SEED), train, cv


def q_als_predict(spark, sf):
    """The held-out pairs the model can score (user and item known from training)."""
    model, _, cv = _als(spark, sf)
    scored = recommend.als_predictor(model)(cv.select("user", "item"))
    return scored.select("user", "item", "score")


def q_factor_text(spark, sf):
    """L2: every factor of both sides as text."""
    model, _, _ = _als(spark, sf)
    u = recommend.factor_text(model.userFactors).withColumn("side", F.lit("user"))
    i = recommend.factor_text(model.itemFactors).withColumn("side", F.lit("item"))
    return u.unionByName(i)


def _some_users(cv: DataFrame) -> DataFrame:
    """The users that recommendations are printed for: the first ones, as in the analysis."""
    return cv.select("user").distinct().orderBy("user").limit(SOME_USERS)


def q_recommend_top_n(spark, sf):
    model, _, cv = _als(spark, sf)
    return recommend.recommend(model, _some_users(cv), TOP_N)


def _given_factors(spark, sf):
    """Factors taken from the data, so that SQL can rank them: customers by their ratings, parts by theirs."""
    r = kept_ratings(spark, sf)

    def side(key):
        g = r.groupBy(F.col(key).alias("id")).agg(F.avg("rating").alias("a"), F.count(F.lit(1)).alias("n"), F.max("rating").alias("m"))
        sign = F.when(F.col("id") % 3 == 0, -1.0).otherwise(1.0)
        return stored(g.select("id", F.array(F.col("a") * sign, F.col("n").cast("double"), F.col("m")).alias("features")), f"{key}-factors")

    return side("user"), side("item")


def q_recommend_blocks(spark, sf):
    """T4 for all users over given factors, in blocks joined on block ids."""
    users, items = _given_factors(spark, sf)
    recs = recommend.recommend_from(users, items, users.select(F.col("id").alias("user")), TOP_N, block=256)
    return recs.select("user", "rank", X.round6("score").alias("score"))


def q_recommendation_names(spark, sf):
    model, _, cv = _als(spark, sf)
    recs = recommend.recommend(model, _some_users(cv), TOP_N)
    named = recs.join(names(spark, sf).withColumnRenamed("id", "item"), "item", "left")
    return named.select("user", "rank", "item", "name", "score")


def q_recommendation_lines(spark, sf):
    model, _, cv = _als(spark, sf)
    return recommend.recommendation_lines(recommend.recommend(model, _some_users(cv), TOP_N))


def q_als_grid(spark, sf):
    """L6 with the whole parameter set: 8 fits of 10 iterations."""
    ratings = kept_ratings(spark, sf)
    train, cv = split(spark, sf, ratings)
    pos = cv.select("user", "item")
    neg = sampling.negative_samples(pos, ratings.select("item"))
    return recommend.als_grid(train, pos, neg, seed=ALS_SEED, parallel=4)


# ---- SQL twins ----

_ITEM_LINE = """CASE WHEN p_partkey % 97 = 0 THEN CAST(p_partkey AS VARCHAR) || ' ' || p_name
     WHEN p_partkey % 89 = 0 THEN 'x' || CAST(p_partkey AS VARCHAR) || chr(9) || p_name
     ELSE CAST(p_partkey AS VARCHAR) || chr(9) || p_name || CASE WHEN p_partkey % 7 = 0 THEN ' ' || chr(13) ELSE '' END END"""

_LENIENT = "SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name FROM part WHERE p_partkey % 97 <> 0 AND p_partkey % 89 <> 0"

_SPLIT = """,
train AS (SELECT * FROM canonical WHERE (k1 * 7919 + k2 * 104729) % 1000 < 900),
cv AS (SELECT * FROM canonical WHERE (k1 * 7919 + k2 * 104729) % 1000 >= 900),
pop AS (SELECT item, sum(rating) AS popularity FROM train GROUP BY item)
"""

_NEG = """,
pos AS (SELECT DISTINCT "user", item FROM cv),
need AS (SELECT "user", count(*) AS n FROM pos GROUP BY "user"),
items AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx FROM (SELECT DISTINCT item FROM canonical)),
ni AS (SELECT count(*) AS n_items FROM items),
draws AS (
  SELECT d."user", d.n, d.j,
         ((d.z * d.z) % 2147483647 * 48271 + d.z) % 2147483647 % ni.n_items AS idx
  FROM (SELECT "user", n, j, ((y * y) % 2147483647 * 69621 + y) % 2147483647 AS z FROM (SELECT "user", n, j, ((((CAST("user" AS BIGINT) * 7919) % 2147483647) * ((CAST("user" AS BIGINT) * 7919) % 2147483647)) % 2147483647 + j) * 48271 % 2147483647 AS y
    FROM (SELECT "user", n, unnest(generate_series(0, (SELECT n_items FROM ni) - 1)) AS j FROM need))) d CROSS JOIN ni),
negs AS (
  SELECT d."user", i.item, d.j, d.n FROM draws d JOIN items i ON d.idx = i.idx
  WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p."user" = d."user" AND p.item = i.item)),
neg AS (SELECT "user", item, j FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY j) AS r FROM negs) WHERE r <= n)
"""

_AUC = """,
ps AS (SELECT c."user", coalesce(p.popularity, 0.0) AS score FROM cv c LEFT JOIN pop p ON c.item = p.item),
ns AS (SELECT n."user", coalesce(p.popularity, 0.0) AS score FROM neg n LEFT JOIN pop p ON n.item = p.item),
np AS (SELECT "user", count(*) AS n_pos FROM ps GROUP BY "user"),
nn AS (SELECT "user", count(*) AS n_neg FROM ns GROUP BY "user"),
ua AS (
  SELECT ps."user", avg(CASE WHEN ps.score > ns.score THEN 1.0 ELSE 0.0 END) AS auc
  FROM ps JOIN ns ON ps."user" = ns."user" GROUP BY ps."user")
"""

_BASE = with_views("ratings", "aliases", "canonical")

SQL = {
    "recommend_blocks": _BASE
    + f""", u AS (SELECT "user", avg(rating) * CASE WHEN "user" % 3 = 0 THEN -1 ELSE 1 END AS a, count(*) AS n, max(rating) AS m FROM canonical GROUP BY "user"),
i AS (SELECT item, avg(rating) * CASE WHEN item % 3 = 0 THEN -1 ELSE 1 END AS a, count(*) AS n, max(rating) AS m FROM canonical GROUP BY item),
s AS (SELECT "user", item, u.a * i.a + u.n * i.n + u.m * i.m AS score FROM u CROSS JOIN i)
SELECT "user", CAST(rank AS INTEGER) AS rank, round(score, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM s) WHERE rank <= {TOP_N}""",
    "ratings_parse": with_views("ratings") + 'SELECT "user", item, CAST(rating AS INTEGER) AS "count" FROM ratings',
    "id_stats": with_views("ratings")
    + """SELECT 'user' AS "column", count(*) AS count, round(avg("user"), 6) AS mean, round(stddev_pop("user"), 6) AS stdev,
  round(min("user")::DOUBLE, 6) AS min, round(max("user")::DOUBLE, 6) AS max FROM ratings
UNION ALL
SELECT 'item', count(*), round(avg(item), 6), round(stddev_pop(item), 6), round(min(item)::DOUBLE, 6), round(max(item)::DOUBLE, 6) FROM ratings""",
    "name_parse_strict": "SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name FROM part",
    "name_parse_lenient": _LENIENT,
    "alias_parse": with_views("aliases") + "SELECT bad, good FROM aliases",
    "name_lookup": f"SELECT * FROM ({_LENIENT}) WHERE id = {LOOKUP_ID} LIMIT 1",
    "substring_filter": f"SELECT value, ord FROM (SELECT {_ITEM_LINE} AS value, p_partkey AS ord FROM part) WHERE contains(value, '{NAME_SUBSTRING}')",
    "preview": f"SELECT {_ITEM_LINE} AS value, p_partkey AS ord FROM part ORDER BY p_partkey LIMIT 10",
    "user_history": with_views("ratings") + f'SELECT "user", item, CAST(rating AS INTEGER) AS "count" FROM ratings WHERE "user" = {USER_ID}',
    "id_count": with_views("ratings") + f"SELECT count(*) AS n FROM ratings WHERE item = {ITEM_ID}",
    "history_names": with_views("ratings")
    + f'SELECT * FROM ({_LENIENT}) WHERE id IN (SELECT item FROM ratings WHERE "user" = {USER_ID})',
    "ratings_canonical": _BASE + 'SELECT "user", item, rating FROM canonical',
    "distinct_items": _BASE + "SELECT DISTINCT item FROM canonical",
    "split_union": _BASE + _SPLIT + 'SELECT "user", item, rating FROM train UNION ALL SELECT "user", item, rating FROM cv',
    "hash_split": _BASE
    + _SPLIT
    + """SELECT 'train' AS split, count(*) AS rows, count(DISTINCT "user") AS users, sum(rating) AS total_rating FROM train
UNION ALL SELECT 'cv', count(*), count(DISTINCT "user"), sum(rating) FROM cv""",
    "hash_sample": _BASE + 'SELECT "user", item, rating, k1, k2 FROM canonical WHERE (k1 * 7919 + k2 * 104729 + 1) % 1000 < 50',
    "popularity": _BASE + _SPLIT + "SELECT item, popularity FROM pop",
    "popularity_predict": _BASE
    + _SPLIT
    + 'SELECT c."user", c.item, coalesce(p.popularity, 0.0) AS score FROM cv c LEFT JOIN pop p ON c.item = p.item',
    "top_n_popular": _BASE + _SPLIT + f"SELECT item, popularity FROM pop ORDER BY popularity DESC, item LIMIT {TOP_N}",
    "user_top_items": _BASE
    + """SELECT "user", item, total, rank FROM (
  SELECT "user", item, total, CAST(row_number() OVER (PARTITION BY "user" ORDER BY total DESC, item) AS INTEGER) AS rank
  FROM (SELECT "user", item, sum(rating) AS total FROM canonical GROUP BY "user", item)) WHERE rank <= 3""",
    "negative_samples": _BASE + _SPLIT + _NEG + 'SELECT "user", item, j FROM neg',
    "user_auc": _BASE
    + _SPLIT
    + _NEG
    + _AUC
    + 'SELECT ua."user", round(auc, 6) AS auc, n_pos, n_neg FROM ua JOIN np ON ua."user" = np."user" JOIN nn ON ua."user" = nn."user"',
    "mean_auc": _BASE + _SPLIT + _NEG + _AUC + "SELECT round(avg(auc), 6) AS mean_auc, count(*) AS users FROM ua",
}

QUERIES = {
    "ratings_parse": q_ratings_parse,
    "id_stats": q_id_stats,
    "name_parse_strict": q_name_parse_strict,
    "name_parse_lenient": q_name_parse_lenient,
    "alias_parse": q_alias_parse,
    "name_lookup": q_name_lookup,
    "substring_filter": q_substring_filter,
    "preview": q_preview,
    "user_history": q_user_history,
    "id_count": q_id_count,
    "history_names": q_history_names,
    "ratings_canonical": q_ratings_canonical,
    "distinct_items": q_distinct_items,
    "split_union": q_split_union,
    "hash_split": q_hash_split,
    "hash_sample": q_hash_sample,
    "popularity": q_popularity,
    "popularity_predict": q_popularity_predict,
    "top_n_popular": q_top_n_popular,
    "user_top_items": q_user_top_items,
    "negative_samples": q_negative_samples,
    "user_auc": q_user_auc,
    "mean_auc": q_mean_auc,
    "als_predict": q_als_predict,
    "factor_text": q_factor_text,
    "recommend_top_n": q_recommend_top_n,
    "recommend_blocks": q_recommend_blocks,
    "recommendation_names": q_recommendation_names,
    "recommendation_lines": q_recommendation_lines,
    "als_grid": q_als_grid,
}
