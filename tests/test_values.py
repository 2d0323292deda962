"""Queries of fitted models return values; what SQL can state of them (rows, labels, totals, ids) is checked here."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.plans import all_queries
from tessera.plans import classify as C
from tessera.plans import cluster as K
from tessera.plans import recommend as R
from tests.test_entry import TABLES, _canon

TEST_ROWS = f"""SELECT {C._RF} AS label, count(*) AS rows FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE (l_orderkey * 7919 + CAST(l_linenumber AS BIGINT) * 104729) % 1000 >= 900 GROUP BY 1"""
LABEL_ROWS = K._MIXED + "SELECT label, count(*) AS rows FROM mixed GROUP BY label"
KNOWN = R._BASE + R._SPLIT
WANTED = f""", wanted AS (SELECT "user" FROM (SELECT DISTINCT "user" FROM cv ORDER BY "user" LIMIT {R.SOME_USERS}) WHERE "user" IN (SELECT "user" FROM train))"""


def vec_rows(lo, hi):
    return f"SELECT CAST(label AS DOUBLE) AS label, count(*) AS rows, true AS shares FROM embeddings WHERE {C._BUCKET} >= {lo} AND {C._BUCKET} < {hi} GROUP BY label"


def metrics(df):
    shares = F.col("precision").between(0, 1) & F.col("recall").between(0, 1)
    return df.select("label", "rows", shares.alias("shares"))


def matrix(df):
    return df.select("label", sum((F.col(c) for c in df.columns[1:]), F.lit(0)).cast("long").alias("rows"))


def share(col):
    return lambda df: df.select(F.col(col).between(0, 1).alias("share"))


def grid_rows(depths, bins):
    rows = ", ".join(f"('{i}', {d}, {b}, true)" for i in C.IMPURITIES for d in depths for b in bins)
    return f"SELECT * FROM (VALUES {rows}) AS g(impurity, depth, bins, shares)"


def grid(df):
    ok = F.col("train_accuracy").between(0, 1) & F.col("cv_accuracy").between(0, 1)
    return df.select("impurity", "depth", "bins", ok.alias("shares"))


def label_rows(k):
    return lambda df: df.where((F.col("cluster") >= 0) & (F.col("cluster") < k)).groupBy("label").agg(F.sum("count").alias("rows"))


def swept(col):
    return lambda df: df.select("k", (F.col(col) >= 0).alias("ok"))


def ks(r):
    return f"SELECT CAST(unnest(range({r.start}, {r.stop}, {r.step})) AS INTEGER) AS k, true AS ok"


CHECKS = {
    "tree_predict": (metrics, vec_rows(800, 900)),
    "tree_refit": (metrics, vec_rows(900, 1000)),
    "tree_categorical": (matrix, TEST_ROWS),
    "tree_categorical_refit": (metrics, f"SELECT *, true AS shares FROM ({TEST_ROWS})"),
    "tree_grid": (grid, grid_rows(C.GRID_DEPTHS, C.GRID_BINS)),
    "tree_categorical_grid": (grid, grid_rows(C.CAT_DEPTHS, C.CAT_BINS)),
    "forest_predict": (matrix, TEST_ROWS),
    "forest_metrics": (metrics, f"SELECT *, true AS shares FROM ({TEST_ROWS})"),
    "forest_accuracy": (share("accuracy"), "SELECT true AS share"),
    "forest_error": (share("error_rate"), "SELECT true AS share"),
    "predict_one": (lambda df: df.select("input", F.col("prediction").isin(0.0, 1.0, 2.0).alias("ok")), f"SELECT '{C.ONE_VECTOR}' AS input, true AS ok"),
    "kmeans_default": (label_rows(2), LABEL_ROWS),
    "kmeans_tuned": (label_rows(K.TUNED_K), LABEL_ROWS),
    "kmeans_centers": (
        lambda df: df.where("value IS NOT NULL AND NOT isnan(value)").groupBy("cluster").agg(F.count("pos").alias("n")).groupBy("n").agg((F.max("cluster") < K.FINAL_K).alias("ok")),
        f"SELECT CAST({K.N_MIXED + sum(K.CAT_SIZES)} AS BIGINT) AS n, true AS ok",
    ),
    "k_sweep_raw": (swept("mean_distance"), ks(K.RAW_KS)),
    "k_sweep_numeric": (swept("mean_distance"), ks(K.NUMERIC_KS)),
    "k_sweep_entropy": (swept("weighted_entropy"), ks(K.ENCODED_KS)),
    "als_predict": (
        lambda df: df.where("NOT isnan(score)").select("user", "item"),
        KNOWN + 'SELECT "user", item FROM cv WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)',
    ),
    "factor_text": (
        lambda df: df.select("id", "side", F.size(F.split("text", ", ")).alias("n")),
        KNOWN + """SELECT DISTINCT "user" AS id, 'user' AS side, 10 AS n FROM train UNION ALL SELECT DISTINCT item, 'item', 10 FROM train""",
    ),
    "recommend_top_n": (lambda df: df.where("score IS NOT NULL").select("user", "rank"), KNOWN + WANTED + f'SELECT "user", unnest(range(1, {R.TOP_N + 1})) AS rank FROM wanted'),
    "recommendation_names": (lambda df: df.where("item IS NOT NULL").select("user", "rank"), KNOWN + WANTED + f'SELECT "user", unnest(range(1, {R.TOP_N + 1})) AS rank FROM wanted'),
    "recommendation_lines": (
        lambda df: df.select("user", F.size(F.split(F.substring_index("line", " -> ", -1), ", ")).alias("n")),
        KNOWN + WANTED + f'SELECT "user", {R.TOP_N} AS n FROM wanted',
    ),
    "als_grid": (
        lambda df: df.select("rank", "lambda", "alpha", F.col("auc").between(0, 1).alias("ok")),
        "SELECT *, true AS ok FROM (SELECT unnest([10, 50]) AS rank) CROSS JOIN (SELECT unnest([1.0, 0.0001])::DOUBLE AS lambda) CROSS JOIN (SELECT unnest([1.0, 40.0])::DOUBLE AS alpha)",
    ),
    "tree_nodes": (
        lambda df: df.agg(F.max(F.when(F.col("id") == 0, F.col("rows"))).alias("root"), F.sum(F.when(F.col("feature") < 0, F.col("rows"))).alias("leaves")),
        f"SELECT count(*) AS root, count(*) AS leaves FROM embeddings WHERE {C._BUCKET} < 800",
    ),
}


@pytest.fixture(scope="module")
def con(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_rows_and_totals(spark, con, sf_small, name):
    reduce, sql = CHECKS[name]
    got = reduce(all_queries()[name](spark, sf_small))
    cur = con.execute(sql)
    assert _canon(got.columns, [tuple(r) for r in got.collect()]) == _canon([d[0] for d in cur.description], cur.fetchall())


def test_grids_are_sorted_best_first(spark, sf_small):
    rows = all_queries()["tree_grid"](spark, sf_small).collect()
    order = [(-r["cv_accuracy"], -r["train_accuracy"], r["impurity"], r["depth"], r["bins"]) for r in rows]
    assert order == sorted(order) and len({r["cv_accuracy"] for r in rows}) > 1
