"""Scoring many models in one scan, exact selection for any n, rows dealt evenly before fits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import classify, cluster, jobs, stats


def points(spark, n=500, d=5, seed=0, kind="label string"):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) + r.integers(0, 4, (n, 1)) * 3
    label = [None if i % 11 == 0 else "abc"[i % 3] for i in range(n)]
    return spark.createDataFrame([(row.tolist(), c) for row, c in zip(x, label, strict=True)], f"features array<double>, {kind}").repartition(5)


def some_models(d=5):
    r = np.random.default_rng(9)
    models = {k: r.normal(size=(k, d)).tolist() for k in (1, 2, 7, 30)}
    models[30][3] = models[30][8]  # two equal centres: the lower id wins
    return models


def test_one_scan_equals_scoring_each_model(spark):
    df, models = points(spark), some_models()
    got = {r["k"]: r["mean_distance"] for r in cluster.mean_distances(df, models).collect()}
    assert got.keys() == models.keys()
    for k, c in models.items():
        assert got[k] == pytest.approx(cluster.mean_distance(df, c).first()[0], rel=1e-12)


@pytest.mark.parametrize("limit", [4_000_000, 50])
def test_counts_and_entropies_equal_each_model(spark, monkeypatch, limit):
    monkeypatch.setattr(cluster, "MAX_COUNTS", limit)
    df, models = points(spark), some_models()
    counts = cluster.cluster_counts(df, models)
    got = {r["k"]: r["weighted_entropy"] for r in cluster.entropies(counts).collect()}
    for k, c in models.items():
        assigned = cluster.assign(df, c)
        want = {(r["cluster"], r["label"]): r["count"] for r in cluster.cluster_label_counts(assigned).collect()}
        assert {(r["cluster"], r["label"]): r["count"] for r in counts.where(F.col("k") == k).collect()} == want
        assert got[k] == pytest.approx(stats.cluster_entropy(assigned).first()[0], abs=1e-9)


def test_nearest_block_is_exact_where_rounding_could_decide():
    r = np.random.default_rng(2)
    c = r.normal(size=(6, 3)) + 1e6
    x = np.concatenate((c + 1e-4 * r.normal(size=(6, 3)), (c[:3] + c[3:]) / 2, c))
    own, d2 = cluster.nearest_block(x, c)
    want = np.array([[((p - q) ** 2).sum() for q in c] for p in x])
    assert own.tolist() == want.argmin(axis=1).tolist()
    assert d2.tolist() == want.min(axis=1).tolist()


def test_sweeps_score_once(spark, monkeypatch):
    df = points(spark)
    calls = []
    for name in ("mean_distances", "cluster_counts"):
        fn = getattr(cluster, name)
        monkeypatch.setattr(cluster, name, lambda *a, fn=fn, name=name, **k: (calls.append(name), fn(*a, **k))[1])
    rows = cluster.k_sweep(df, range(2, 6), seed=1, parallel=2).collect()
    assert [r["k"] for r in rows] == [2, 3, 4, 5] and rows[0]["mean_distance"] > rows[3]["mean_distance"] > 0
    rows = cluster.k_sweep_entropy(df, [2, 3], seed=1).collect()
    assert all(0 <= r["weighted_entropy"] <= math.log(4) for r in rows)
    assert calls == ["mean_distances", "cluster_counts"]


def test_lloyd_equals_plain_steps(spark):
    df = points(spark, 300, 3)
    x = np.array([r["features"] for r in df.collect()])
    c = x[:6].copy()
    c[5] = 1e9  # never nearest: stays
    want = c.copy()
    for _ in range(3):
        own = ((x[:, None] - want[None]) ** 2).sum(axis=2).argmin(axis=1)
        want = np.array([x[own == j].mean(axis=0) if (own == j).any() else want[j] for j in range(6)])
    assert np.allclose(cluster.lloyd(df, c.tolist(), 3), want, rtol=1e-12)


@pytest.mark.parametrize("kind", ["wide", "ties", "special", "whole"])
def test_nth_largest_for_any_n(spark, kind):
    r = np.random.default_rng(4)
    if kind == "wide":
        x = (r.normal(size=3000) * 10.0 ** r.integers(-300, 300, 3000)).tolist()
    elif kind == "ties":
        x = r.integers(0, 3, 3000).astype(float).tolist()
    elif kind == "special":
        x = r.normal(size=2000).tolist() + [math.inf] * 300 + [-math.inf] * 300 + [math.nan] * 200 + [None] * 200 + [1.7e308, -1.7e308]
    else:
        x = r.integers(-(10**17), 10**17, 1500).tolist() + (10**17 + r.integers(0, 30, 1500)).tolist()
    df = spark.createDataFrame([(v,) for v in x], f"v {'long' if kind == 'whole' else 'double'}").repartition(4)
    order = sorted((v for v in x if v is not None), key=lambda v: (math.isnan(v), v), reverse=True)
    for n in (5, 201, 500, 501, 2300, len(order) + 7):
        got = cluster.nth_largest(df, "v", n, at_once=20, accuracy=50).first()["threshold"]
        want = order[min(n, len(order)) - 1]
        assert got == want or (math.isnan(got) and math.isnan(want)), n


def test_a_million_ranks_equal_a_full_sort(spark):
    df = spark.range(3_000_000).select(F.exp(F.sin(F.col("id") * 0.37) * 20).alias("v"))
    n = 1_000_000
    want = df.orderBy(F.col("v").desc()).offset(n - 1).limit(1).first()["v"]
    assert cluster.nth_largest(df, "v", n).first()["threshold"] == want


def test_fits_read_evenly_dealt_rows(spark, monkeypatch):
    seen = []
    real = cluster._fit_vectors
    monkeypatch.setattr(cluster, "_fit_vectors", lambda vec, *a: (seen.append(vec.rdd.getNumPartitions()), real(vec, *a))[1])
    cluster.fit_kmeans(points(spark).coalesce(1), k=2, seed=1)
    cluster.k_sweep(points(spark).coalesce(1), [2], seed=1)
    assert seen == [spark.sparkContext.defaultParallelism] * 2
    rows = classify.with_vector(spark.createDataFrame([(float(i % 2), [float(i % 2), 1.0]) for i in range(50)], "label double, features array<double>")).coalesce(1)
    fitted = []
    classify._fitted_on(type("E", (), {"fit": lambda self, d: fitted.append(d.rdd.getNumPartitions())})(), rows)
    monkeypatch.setattr(classify, "ROWS_PER_PART", 20)
    classify._fitted_on(type("E", (), {"fit": lambda self, d: fitted.append(d.rdd.getNumPartitions())})(), rows)
    monkeypatch.setattr(classify, "ROWS_PER_PART", 1)
    classify._fitted_on(type("E", (), {"fit": lambda self, d: fitted.append(d.rdd.getNumPartitions())})(), rows)
    assert fitted == [1, 2, spark.sparkContext.defaultParallelism]  # 50 rows: whole, in twenties, over all cores


def test_a_failing_job_stops_the_others(spark):
    import time

    t = time.perf_counter()

    def work(i):
        if i == 0:
            raise ValueError("first")
        return spark.range(4).select(F.expr("reflect('java.lang.Thread', 'sleep', 20000L)")).collect()

    with pytest.raises(ValueError, match="first"):
        jobs.map_jobs(work, range(6), parallel=3)
    assert time.perf_counter() - t < 15
    assert jobs.map_jobs(lambda i: i * i, range(5), parallel=3) == [0, 1, 4, 9, 16]
