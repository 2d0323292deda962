"""Classification queries: labelled vectors, one-hot decoding, priors, metrics, trees and forests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators import classify, evaluate, features, sampling, stats, trees
from tessera.plans.views import with_views
from tessera.session import stored, table
from tessera.sources import fixtures, text

SEED = 11
N_NUMERIC = 6


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    return text.parse_labeled(fixtures.labeled_lines(spark, sf), keep=["vec_id"])


def labeled_splits(spark, sf):
    """train / cv / test = 80 / 10 / 10 by vec_id bucket."""
    return sampling.hash_split(labeled(spark, sf), [0.8, 0.1, 0.1], bucket=sampling.arithmetic_bucket("vec_id"))


def labeled_cat(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[int, int]]:
    """Line items with the type and brand one-hot blocks decoded to category indices; the lines are joined once."""
    lines = stored(fixtures.labeled_cat_lines(spark, sf), "labeled-lines")
    parsed = text.parse_labeled(lines, keep=["k1", "k2"])
    cats = features.small_categories(table(spark, sf, "part"), ["p_type", "p_brand"])
    n_types, n_brands = len(cats["p_type"]), len(cats["p_brand"])
    blocks = [(N_NUMERIC, n_types), (N_NUMERIC + n_types, n_brands)]
    dec = classify.decode_one_hot(parsed, "features", N_NUMERIC, blocks)
    return dec, {N_NUMERIC: n_types, N_NUMERIC + 1: n_brands}


def cat_splits(spark, sf):
    df, cats = labeled_cat(spark, sf)
    df = classify.with_vector(df, "features", cats, width=N_NUMERIC + 2)
    parts = sampling.hash_split(df, [0.8, 0.1, 0.1], bucket=sampling.arithmetic_bucket("k1", "k2"))
    return parts, cats


def vec_splits(spark, sf):
    return [classify.with_vector(p) for p in labeled_splits(spark, sf)]


def q_labeled_vector(spark, sf):
    df = labeled(spark, sf)
    return df.select(
        "vec_id",
        "label",
        F.size("features").alias("n_features"),
        X.round6(X.array_sum("features")).alias("total"),
        X.round6(F.element_at("features", 1)).alias("first"),
        X.round6(F.element_at("features", -1)).alias("last"),
    )


def q_one_hot_decode(spark, sf):
    df, _ = labeled_cat(spark, sf)
    return df.select("k1", "k2", "label", *[X.round6(F.get(F.col("features"), i)).alias(f"f{i}") for i in range(N_NUMERIC + 2)])


def q_class_priors(spark, sf):
    train, _, _ = labeled_splits(spark, sf)
    return stats.class_priors(train).select("label", "count", X.round6("prior").alias("prior"))


def q_chance_agreement(spark, sf):
    train, cv, _ = labeled_splits(spark, sf)
    return stats.chance_agreement(train, cv).select(X.round6("chance").alias("chance"))


def q_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(fixtures.scored_rows(spark, sf))


def q_accuracy(spark, sf):
    return evaluate.accuracy(fixtures.scored_rows(spark, sf)).select(X.round6("accuracy").alias("accuracy"))


def q_error_rate(spark, sf):
    return evaluate.error_rate(fixtures.scored_rows(spark, sf)).select(X.round6("error_rate").alias("error_rate"))


def q_precision_recall(spark, sf):
    out = evaluate.precision_recall(fixtures.scored_rows(spark, sf))
    return out.select("label", X.round6("precision").alias("precision"), X.round6("recall").alias("recall"))


# ---- fitted models ----
# These return the fitted values.  SQL cannot repeat them: tests/test_models.py and tests/test_trees.py
# check them (rows, labels and totals against the data, predictions against the model, every depth
# against a fit of that depth), and ``tree_stump`` holds a split against SQL.

# The analysis' hyperparameters.
IMPURITIES = ("gini", "entropy")
GRID_DEPTHS, GRID_BINS = (1, 20), (10, 300)
CAT_DEPTHS, CAT_BINS = (10, 20, 30), (40, 300)
REFIT_DEPTH, CAT_REFIT_DEPTH, REFIT_BINS = 20, 30, 300
TREES = 20
ONE_VECTOR = "25.0,36000.5,0.04,0.02,30.0,950.0,3.0,11.0"

def _fit_tree(df, impurity, depth, bins):
    return classify.fit_tree(df, impurity, depth, bins, SEED)


def _metrics(preds: DataFrame) -> DataFrame:
    """Per label: rows, precision and recall."""
    rows = preds.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(evaluate.precision_recall(preds), "label").select("label", "rows", "precision", "recall")


def _forest_test(spark, sf):
    """Test rows with the prediction of the analysis' forest: 20 trees, entropy, depth 30, 300 bins."""
    (train, _, test), _ = cat_splits(spark, sf)
    return trees.deep_predictions(train, test, "entropy", CAT_REFIT_DEPTH, REFIT_BINS, SEED, TREES)


def q_tree_predict(spark, sf):
    train, cv, _ = vec_splits(spark, sf)
    return _metrics(classify.predictions(_fit_tree(train, "gini", 4, 100), cv))


def q_tree_text(spark, sf):
    train, _, _ = vec_splits(spark, sf)
    return classify.tree_text(_fit_tree(train, "gini", 4, 100))


def q_tree_nodes(spark, sf):
    """L8 as data: every node of the tree with the training rows that pass it."""
    train, _, _ = vec_splits(spark, sf)
    model = _fit_tree(train, "gini", 4, 100)
    nodes = trees.training_rows(trees.tree_nodes(model, spark), trees.walk_of(model, spark), train)
    return nodes.select("id", "feature", "threshold", "left", "right", "prediction", "impurity", "gain", "rows")


def q_tree_stump(spark, sf):
    """The best two-set split of the return flag by the item's type: what a tree of depth 1 starts with."""
    df, cats = labeled_cat(spark, sf)
    typed = df.select("label", F.element_at("features", N_NUMERIC + 1).cast("int").alias("type"))
    best = trees.best_category_split(typed, "type", "label", [0.0, 1.0, 2.0])
    return best.select("left", F.round("gain", 9).alias("gain"), "left_rows", "right_rows")


def q_tree_categorical(spark, sf):
    """Train + cv, categorical features declared, depth 30, 300 bins; confusion matrix on test."""
    (train, cv, test), _ = cat_splits(spark, sf)
    return evaluate.confusion_matrix(trees.deep_predictions(train.unionByName(cv), test, "entropy", CAT_REFIT_DEPTH, REFIT_BINS, SEED))


def q_tree_grid(spark, sf):
    train, cv, _ = vec_splits(spark, sf)
    return trees.deep_grid(train, cv, IMPURITIES, GRID_DEPTHS, GRID_BINS, SEED, parallel=4)


def q_tree_categorical_grid(spark, sf):
    (train, cv, _), _ = cat_splits(spark, sf)
    return trees.deep_grid(train, cv, IMPURITIES, CAT_DEPTHS, CAT_BINS, SEED, parallel=4)


def q_tree_refit(spark, sf):
    """The best plain tree (no categories declared) fitted again on train + cv, tested on test."""
    train, cv, test = vec_splits(spark, sf)
    return _metrics(trees.deep_predictions(train.unionByName(cv), test, "entropy", REFIT_DEPTH, REFIT_BINS, SEED))


def q_tree_categorical_refit(spark, sf):
    """L11 with declared categories: per-class precision and recall on test."""
    (train, cv, test), _ = cat_splits(spark, sf)
    return _metrics(trees.deep_predictions(train.unionByName(cv), test, "entropy", CAT_REFIT_DEPTH, REFIT_BINS, SEED))


def q_forest_predict(spark, sf):
    return evaluate.confusion_matrix(_forest_test(spark, sf))


def q_forest_metrics(spark, sf):
    return _metrics(_forest_test(spark, sf))


def q_forest_accuracy(spark, sf):
    return evaluate.accuracy(_forest_test(spark, sf))


def q_forest_grid(spark, sf):
    (train, cv, _), _ = cat_splits(spark, sf)
    return trees.deep_grid(train, cv, IMPURITIES, CAT_DEPTHS, CAT_BINS, SEED, TREES, parallel=6)


def q_forest_error(spark, sf):
    return evaluate.error_rate(_forest_test(spark, sf))


def q_predict_one(spark, sf):
    (train, _, _), _ = cat_splits(spark, sf)
    one = classify.one_vector(ONE_VECTOR).withColumn("label", F.lit(None).cast("double"))
    got = trees.deep_predictions(train, one, "entropy", CAT_REFIT_DEPTH, REFIT_BINS, SEED, TREES)
    return got.select(F.lit(ONE_VECTOR).alias("input"), "prediction")


def q_leading_columns(spark, sf):
    """Only the first ten features of each line."""
    df = text.parse_labeled(fixtures.labeled_lines(spark, sf), n_features=10, keep=["vec_id"])
    return df.select("vec_id", "label", F.size("features").alias("n_features"), X.round6(X.array_sum("features")).alias("total"))


_RF = "CAST(CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END AS DOUBLE)"
_BUCKET = "(vec_id * 7919) % 1000"

_LABELED = f"""WITH lab AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
train AS (SELECT * FROM lab WHERE {_BUCKET} < 800),
cv AS (SELECT * FROM lab WHERE {_BUCKET} >= 800 AND {_BUCKET} < 900),
pt AS (SELECT label, count(*) AS count, count(*) / sum(count(*)) OVER () AS prior FROM train GROUP BY label),
pc AS (SELECT label, count(*) / sum(count(*)) OVER () AS prior FROM cv GROUP BY label)
"""

_DECODE = f"""WITH j AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),
t AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS ti FROM (SELECT DISTINCT p_type FROM part)),
b AS (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS bi FROM (SELECT DISTINCT p_brand FROM part))
SELECT l_orderkey AS k1, CAST(l_linenumber AS BIGINT) AS k2, {_RF} AS label,
  round(l_quantity, 6) AS f0, round(l_extendedprice, 6) AS f1, round(l_discount, 6) AS f2, round(l_tax, 6) AS f3,
  round(CAST(p_size AS DOUBLE), 6) AS f4, round(p_retailprice, 6) AS f5, CAST(ti AS DOUBLE) AS f6, CAST(bi AS DOUBLE) AS f7
FROM j JOIN t USING (p_type) JOIN b USING (p_brand)"""

# All two-set splits of the types, by their counts.
_STUMP = f"""WITH t AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS c FROM (SELECT DISTINCT p_type FROM part)),
n AS (SELECT c, {_RF} AS l, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN t USING (p_type) GROUP BY ALL),
s AS (SELECT b FROM range(1, CAST((SELECT 1 << count(*) FROM t) AS BIGINT) - 1, 2) AS r(b)),
side AS (SELECT b, (b >> c) & 1 AS is_left, l, sum(n) AS n FROM n CROSS JOIN s GROUP BY ALL),
g AS (SELECT b, is_left, sum(n) AS rows, 1 - sum(n * n) / (sum(n) * sum(n)) AS gini FROM side GROUP BY b, is_left),
whole AS (SELECT sum(n) AS rows, 1 - sum(n * n) / (sum(n) * sum(n)) AS gini FROM (SELECT l, sum(n) AS n FROM n GROUP BY l)),
gain AS (SELECT b, any_value(whole.gini) - sum(g.rows * g.gini) / any_value(whole.rows) AS gain,
  sum(CASE WHEN is_left = 1 THEN g.rows END) AS left_rows, sum(CASE WHEN is_left = 0 THEN g.rows END) AS right_rows FROM g CROSS JOIN whole GROUP BY b)
SELECT (SELECT string_agg(c, ',' ORDER BY c) FROM t WHERE (b >> c) & 1 = 1) AS left, round(CAST(gain AS DOUBLE), 9) AS gain,
  CAST(left_rows AS BIGINT) AS left_rows, CAST(right_rows AS BIGINT) AS right_rows FROM gain ORDER BY gain DESC, b LIMIT 1"""

SQL = {
    "tree_stump": _STUMP,
    "leading_columns": """SELECT vec_id, CAST(label AS DOUBLE) AS label, 10 AS n_features,
  round(list_sum(CAST(embedding AS DOUBLE[])[1:10]), 6) AS total FROM embeddings""",
    "labeled_vector": """SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(len(embedding) AS INTEGER) AS n_features,
  round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total, round(CAST(embedding[1] AS DOUBLE), 6) AS first,
  round(CAST(embedding[len(embedding)] AS DOUBLE), 6) AS last FROM embeddings""",
    "one_hot_decode": _DECODE,
    "class_priors": _LABELED + "SELECT label, count, round(prior, 6) AS prior FROM pt",
    "chance_agreement": _LABELED + "SELECT round(sum(pt.prior * pc.prior), 6) AS chance FROM pt JOIN pc USING (label)",
    "confusion_matrix": with_views("scored")
    + """SELECT label, count(*) FILTER (WHERE prediction = 0.0) AS p0, count(*) FILTER (WHERE prediction = 1.0) AS p1,
  count(*) FILTER (WHERE prediction = 2.0) AS p2 FROM scored GROUP BY label""",
    "accuracy": with_views("scored") + "SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored",
    "error_rate": with_views("scored") + "SELECT round(avg(CASE WHEN label <> prediction THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM scored",
    "precision_recall": with_views("scored")
    + """, a AS (SELECT label, count(*) AS actual, count(*) FILTER (WHERE label = prediction) AS tp FROM scored GROUP BY label),
p AS (SELECT prediction AS label, count(*) AS predicted FROM scored GROUP BY prediction)
SELECT a.label, round(coalesce(tp / predicted, 0.0), 6) AS precision, round(tp / actual, 6) AS recall
FROM a LEFT JOIN p ON a.label = p.label""",
}

QUERIES = {
    "labeled_vector": q_labeled_vector,
    "one_hot_decode": q_one_hot_decode,
    "class_priors": q_class_priors,
    "chance_agreement": q_chance_agreement,
    "confusion_matrix": q_confusion_matrix,
    "accuracy": q_accuracy,
    "error_rate": q_error_rate,
    "precision_recall": q_precision_recall,
    "tree_predict": q_tree_predict,
    "tree_text": q_tree_text,
    "tree_nodes": q_tree_nodes,
    "tree_stump": q_tree_stump,
    "tree_categorical": q_tree_categorical,
    "tree_grid": q_tree_grid,
    "tree_categorical_grid": q_tree_categorical_grid,
    "tree_refit": q_tree_refit,
    "forest_predict": q_forest_predict,
    "forest_grid": q_forest_grid,
    "forest_error": q_forest_error,
    "predict_one": q_predict_one,
    "tree_categorical_refit": q_tree_categorical_refit,
    "forest_metrics": q_forest_metrics,
    "forest_accuracy": q_forest_accuracy,
    "leading_columns": q_leading_columns,
}
