"""Property tests for fitted models (rows-only queries)."""

from pyspark.sql import functions as F

from tessera.operators import classify, evaluate, recommend


def ratings(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 3 == 0]
    return spark.createDataFrame(rows, "user int, item int, rating double")


def test_als_seeded_fit_is_repeatable_across_partitionings(spark):
    r = ratings(spark)
    m1 = recommend.fit_als(r, rank=3, max_iter=3, seed=5, partitions=2)
    m2 = recommend.fit_als(r.repartition(5), rank=3, max_iter=3, seed=5, partitions=2)
    f1 = sorted((x.id, tuple(round(v, 5) for v in x.features)) for x in m1.userFactors.collect())
    f2 = sorted((x.id, tuple(round(v, 5) for v in x.features)) for x in m2.userFactors.collect())
    assert f1 == f2
    pairs = spark.createDataFrame([(1, 2), (999, 2)], "user int, item int")
    preds = recommend.als_predictor(m1)(pairs).collect()
    assert [p.user for p in preds] == [1]  # unknown user yields no row
    recs = recommend.recommend(m1, spark.createDataFrame([(1,), (2,)], "user int"), 3)
    assert recs.groupBy("user").count().filter("count = 3").count() == 2


def test_popularity_predictor_defaults_to_zero(spark):
    train = spark.createDataFrame([(1, 10, 2.0), (2, 10, 3.0)], "user int, item int, rating double")
    pairs = spark.createDataFrame([(1, 10), (1, 11)], "user int, item int")
    got = {r.item: r.score for r in recommend.popularity_predictor(train)(pairs).collect()}
    assert got == {10: 5.0, 11: 0.0}


def test_canonical_ratings(spark):
    r = spark.createDataFrame([(1, 5, 1.0), (1, 6, 2.0)], "user int, item int, rating double")
    a = spark.createDataFrame([(5, 6)], "bad int, good int")
    assert sorted(x.item for x in recommend.canonical_ratings(r, a).collect()) == [6, 6]
    agg = recommend.canonical_ratings(r, a, aggregate=True).collect()
    assert len(agg) == 1 and agg[0].rating == 3.0


def _labeled(spark):
    rows = [(float(i % 3), [float(i % 3) + (i % 7) * 0.01, float(i % 4)]) for i in range(120)]
    return classify.with_vector(spark.createDataFrame(rows, "label double, features array<double>"))


def test_tree_predictions_in_label_range_and_grid_sorted(spark):
    df = _labeled(spark)
    m = classify.fit_tree(df, "gini", 3, 16, seed=1)
    preds = classify.predictions(m, df)
    assert {r.prediction for r in preds.select("prediction").distinct().collect()} <= {0.0, 1.0, 2.0}
    assert evaluate.accuracy(preds).first().accuracy > 0.9
    fit = lambda d, impurity, depth, bins: classify.fit_tree(d, impurity, depth, bins, seed=1)
    g = classify.grid(df, df, fit, ("gini", "entropy"), (1, 3), (8,)).collect()
    assert [r.cv_accuracy for r in g] == sorted([r.cv_accuracy for r in g], reverse=True)
    assert "If" in classify.tree_text(m).first().text


def test_categorical_metadata_splits_on_sets(spark):
    rows = [(float(i % 2), [float(i % 4), 0.5]) for i in range(80)]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    df = classify.with_vector(df, "features", {0: 4}, width=2)
    m = classify.fit_tree(df, "gini", 2, 8, seed=1)
    assert "in {" in m.toDebugString
    f = classify.fit_forest(df, trees=3, depth=2, bins=8, seed=1)
    assert classify.predict_values(f, "1.0,0.5").first().prediction in (0.0, 1.0)
