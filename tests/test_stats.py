import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import stats


def test_missing_stats_all_missing_and_population_stdev(spark):
    df = spark.createDataFrame([([1.0, None],), ([3.0, None],), ([float("nan"), None],)], "a array<double>")
    out = {r.pos: r for r in stats.missing_stats(df, "a", width=2).collect()}
    assert out[0]["count"] == 2 and out[0].missing == 1 and out[0].mean == 2.0 and out[0].stdev == 1.0
    assert out[1]["count"] == 0 and out[1].missing == 3 and out[1].mean is None
    out2 = {r.pos: r for r in stats.missing_stats(df, "a").collect()}
    assert out2[0].mean == 2.0 and out2[1]["count"] == 0


def test_missing_stats_empty_input(spark):
    df = spark.createDataFrame([], "a array<double>")
    rows = stats.missing_stats(df, "a", width=2).collect()
    assert [r["count"] for r in rows] == [0, 0]


def test_feature_contrast(spark):
    df = spark.createDataFrame([([1.0, None], True), ([3.0, 1.0], True), ([0.0, 5.0], False)], "s array<double>, m boolean")
    out = {r.pos: r for r in stats.feature_contrast(df, "s", "m", 2).collect()}
    assert out[0].mean_diff == 2.0 and out[0].missing == 0
    assert out[1].mean_diff == -4.0 and out[1].missing == 1


def test_score_threshold_and_pair_score(spark):
    df = spark.createDataFrame([([0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1.0, None], True), ([0.0] * 9, False)], "scores array<double>, matched boolean")
    scored = df.withColumn("score", stats.pair_score(df))
    assert sorted(r.score for r in scored.collect()) == [0.0, 4.0]
    t = {(r.threshold, r.matched): r["count"] for r in stats.score_threshold(scored, "score", "matched").collect()}
    assert t == {(4.0, True): 1, (2.0, True): 1}


def test_entropy(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 0)], "k string, count long")
    h = stats.entropy(counts).first().entropy
    p = [0.25, 0.25, 0.5]
    assert math.isclose(h, -sum(x * math.log(x) for x in p))


def test_cluster_entropy_weighted(spark):
    df = spark.createDataFrame([(0, "x"), (0, "x"), (1, "x"), (1, "y")], "cluster int, label string")
    h = stats.cluster_entropy(df).first()[0]
    assert math.isclose(h, 0.5 * 0 + 0.5 * math.log(2))


def test_priors_and_chance(spark):
    a = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (1.0,)], "label double")
    b = spark.createDataFrame([(1.0,), (2.0,)], "label double")
    pr = {r.label: r.prior for r in stats.class_priors(a).collect()}
    assert pr == {0.0: 0.25, 1.0: 0.75}
    # classes are matched by id: only class 1 is shared
    assert math.isclose(stats.chance_agreement(a, b).first()[0], 0.75 * 0.5)


def test_column_stats_one_pass(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "x double, y double")
    out = {r.column: r for r in stats.column_stats(df, ["x", "y"]).collect()}
    assert out["x"].mean == 2.0 and out["y"]["count"] == 1 and out["y"].missing == 1
