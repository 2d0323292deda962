"""Fits of many models in the same scans, records joined once, shuffles of a fit deleted as it goes on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster, features, kmeans_many, recommend
from tessera.plans import classify
from tessera.plans import cluster as plans
from tessera.session import table


def cloud(spark, n=900, d=3, k=5):
    r = np.random.default_rng(3)
    x = r.normal(size=(n, d)) * 0.1 + 10 * r.integers(0, k, (n, 1))
    return x, spark.createDataFrame([(row.tolist(), "ab"[i % 2]) for i, row in enumerate(x)], "features array<double>, label string").repartition(3)


def test_many_fits_settle_where_plain_rounds_stay(spark, monkeypatch):
    monkeypatch.setattr(kmeans_many, "PACK_ROWS", 100)
    x, df = cloud(spark)
    models = kmeans_many.fit_many(df, {0: (5, 1), 1: (5, 2), 2: (9, 1), 3: (1, 1)}, 1e-9, 50)
    assert [len(models[m].centers) for m in range(4)] == [5, 5, 9, 1]
    for m in models.values():
        own = ((x[:, None] - m.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[own == j].mean(axis=0) for j in range(len(m.centers))])
        assert np.allclose(moved, m.centers, atol=1e-6)
        assert m.cost == pytest.approx(((x - m.centers[own]) ** 2).sum(), rel=1e-6)
    # Five far groups: both seeds find them, and each group is one cluster.
    assert models[0].cost == pytest.approx(models[1].cost) and models[0].cost < 60


def test_equal_rows_give_no_more_centres_than_values(spark):
    df = spark.createDataFrame([([float(i % 3), 1.0],) for i in range(300)], "features array<double>")
    m = kmeans_many.fit_many(df, {0: (7, 1)})[0]
    assert sorted(c[0] for c in m.clusterCenters()) == [0.0, 1.0, 2.0]


@pytest.mark.parametrize("bad", [[1.0, None], [1.0], None])
def test_rows_that_do_not_fit_fail(spark, bad):
    df = spark.createDataFrame([([0.0, 1.0],), (bad,)], "features array<double>").coalesce(1)
    with pytest.raises(Exception, match="without nulls"):
        kmeans_many.fit_many(df, {0: (1, 1)})


def test_long_inputs_are_fitted_in_the_same_scans(spark, monkeypatch):
    _, df = cloud(spark)
    monkeypatch.setattr(cluster, "MANY_ROWS", 100)
    monkeypatch.setattr(cluster, "_fit_vectors", lambda *a: pytest.fail("one fit per model"))
    passes = []
    real = kmeans_many._added
    monkeypatch.setattr(kmeans_many, "_added", lambda blocks, models, *a, **k: (passes.append(len(models)), real(blocks, models, *a, **k))[1])
    rows = cluster.k_sweep(df, [2, 3, 5], seed=1).collect()
    assert [r["k"] for r in rows] == [2, 3, 5] and rows[2]["mean_distance"] < 0.4 < rows[0]["mean_distance"]
    assert passes[0] == 3 and len(passes) <= 22
    assert [r["k"] for r in cluster.k_sweep_entropy(df, [2, 3], seed=1).collect()] == [2, 3]
    assert len(cluster.centers_from_model(cluster.fit_kmeans(df, 5, seed=1, runs=3))) == 5


def _tables(spark, path, n=60):
    i = F.col("id")
    ts = F.lit("2020-01-01").cast("timestamp_ntz")
    spark.range(n).select(i.alias("l_orderkey"), i.alias("l_partkey"), i.alias("l_suppkey"), i.cast("int").alias("l_linenumber"), (i % 7).cast("double").alias("l_quantity"), (i * 1.5).alias("l_extendedprice"), (i % 3 / 10).alias("l_discount"), (i % 5 / 10).alias("l_tax"), F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (i % 3 + 1).cast("int")).alias("l_returnflag"), ts.alias("l_shipdate")).write.parquet(f"{path}/lineitem.parquet")
    spark.range(n).select(i.alias("o_orderkey"), i.alias("o_custkey"), F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (i % 3 + 1).cast("int")).alias("o_orderstatus"), (i * 2.0).alias("o_totalprice"), F.concat(F.lit("p"), (i % 5).cast("string")).alias("o_orderpriority")).write.parquet(f"{path}/orders.parquet")
    spark.range(n).select(i.alias("p_partkey"), F.lit("a b").alias("p_name"), F.lit("x").alias("p_brand"), F.lit("t").alias("p_type"), (i % 9).cast("int").alias("p_size"), (i + 0.5).alias("p_retailprice")).write.parquet(f"{path}/part.parquet")


@pytest.mark.parametrize("name", ["category_index", "one_hot", "zscore", "sparse_one_hot", "sparse_zscore"])
def test_records_are_joined_once(spark, tmp_path, monkeypatch, name):
    """The width, the categories, the moments and the rows all read stored lines."""
    _tables(spark, str(tmp_path))
    out = plans.QUERIES[name](spark, str(tmp_path))
    assert out.count() == (11 if name == "category_index" else 60)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
    assert table(spark, str(tmp_path), "lineitem").count() == 60


@pytest.mark.parametrize("name, rows", [("one_hot_decode", 60), ("tree_stump", 1)])
def test_labelled_lines_are_joined_once(spark, tmp_path, name, rows):
    _tables(spark, str(tmp_path))
    # A stump needs two types.
    spark.read.parquet(f"{tmp_path}/part.parquet").withColumn("p_type", F.concat(F.lit("t"), (F.col("p_partkey") % 2).cast("string"))).write.parquet(f"{tmp_path}/typed/part.parquet")
    spark.read.parquet(f"{tmp_path}/lineitem.parquet").write.parquet(f"{tmp_path}/typed/lineitem.parquet")
    out = classify.QUERIES[name](spark, f"{tmp_path}/typed")
    assert out.count() == rows
    assert "l_partkey" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_zscore_compiled_equals_general(spark, monkeypatch):
    df = spark.createDataFrame([([1.0, 2.0, None],), ([4.0, 5.0, 6.0],), ([1.0],), ([1.0, 2.0, 3.0, 4.0],), (None,)], "features array<double>")
    args = ("features", [1.5, 2.0, 0.0], [2.0, 0.0, None])
    fast = features.zscore(df, *args).collect()
    monkeypatch.setattr(features, "MAX_COMPILED_WIDTH", 0)
    assert fast == features.zscore(df, *args).collect()


def test_a_fit_deletes_its_shuffles_every_iteration(spark, monkeypatch):
    seen = []
    real = recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **k: (seen.append(k["checkpointInterval"]), real(**k))[1])
    recommend.fit_als(spark.createDataFrame([(i % 4, i % 3, 1.0) for i in range(12)], "user int, item int, rating double"), rank=2, max_iter=2)
    assert seen == [1] and spark.sparkContext.getCheckpointDir() is not None
