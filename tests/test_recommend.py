"""Recommendations for many users in blocks, and one implicit ALS half-step against a plain solve."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recommend


def factors(spark, n, d, seed, spread=1.0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) * np.exp(spread * r.normal(size=(n, 1)))
    x = x.astype(np.float32)
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id int, features array<float>").repartition(3), x.astype(float)


def brute(u, v, n):
    out = []
    for i, a in enumerate(u):
        s = np.zeros(len(v))
        for k in range(v.shape[1]):
            s += a[k] * v[:, k]
        for r, j in enumerate(np.lexsort((np.arange(len(v)), -s))[:n]):
            out.append((i, int(j), float(s[j]), r + 1))
    return out


@pytest.mark.parametrize("n, block", [(5, 40), (70, 16), (3, 4096)])
def test_blocks_equal_brute_force(spark, n, block):
    uf, u = factors(spark, 150, 6, 1)
    vf, v = factors(spark, 400, 6, 2)
    u[7] = 0.0
    uf = uf.withColumn("features", F.when(F.col("id") == 7, F.transform("features", lambda x: x * 0)).otherwise(F.col("features")))
    users = spark.range(150).select(F.col("id").cast("int").alias("user")).union(spark.createDataFrame([(3,), (9999,)], "user int"))
    got = sorted((tuple(r) for r in recommend.recommend_from(uf, vf, users, n, block).collect()), key=lambda r: (r[0], r[3]))
    assert got == brute(u, v, n)


def test_the_norm_bound_skips_blocks(spark, monkeypatch):
    uf, u = factors(spark, 60, 4, 3, spread=0.1)
    vf, v = factors(spark, 2000, 4, 4, spread=2.5)
    seen = []
    real = recommend._best_of_pairs
    monkeypatch.setattr(recommend, "_best_of_pairs", lambda pairs, *a: (seen.append(pairs.count()), real(pairs, *a))[1])
    got = recommend.recommend_from(uf, vf, spark.range(60).select(F.col("id").cast("int").alias("user")), 3, 20)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[3])) == brute(u, v, 3)
    assert sum(seen) < 0.6 * 3 * 100  # 3 or more user blocks x 100 item blocks without the bound


def test_components_bound_scores_where_lengths_do_not(spark, monkeypatch):
    """Items of about one length and direction: a user across it needs few of their blocks."""
    r = np.random.default_rng(9)
    x = np.column_stack([r.uniform(-30, 30, 3000), r.integers(900, 1000, 3000), r.uniform(20, 50, 3000)])
    u = np.column_stack([r.choice([-25.0, 25.0], 90), r.integers(1, 60, 90), np.full(90, 50.0)])
    uf, vf = (spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(m)], "id int, features array<double>") for m in (u, x))
    seen = []
    real = recommend._best_of_pairs
    monkeypatch.setattr(recommend, "_best_of_pairs", lambda pairs, *a: (seen.append(pairs.count()), real(pairs, *a))[1])
    got = recommend.recommend_from(uf, vf, spark.range(90).select(F.col("id").cast("int").alias("user")), 3, 20)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[3])) == brute(u, x, 3)
    assert sum(seen) < 0.4 * 5 * 150  # 5 or more user blocks x 150 item blocks


def test_ratings_are_joined_once_for_a_fit(spark, sf_small, monkeypatch):
    from tessera.plans import recommend as plans

    plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(recommend, "fit_als", lambda train, *a, **k: plan_of(train))
    plan, train, cv = plans._als(spark, sf_small)
    assert "Join" not in plan and "Join" not in plan_of(cv) and train.count() + cv.count() == plans.all_ratings(spark, sf_small).count()
    users, items = plans._given_factors(spark, sf_small)
    assert "Join" not in plan_of(users) + plan_of(items)


def test_edges(spark):
    uf, _ = factors(spark, 4, 3, 5)
    vf, v = factors(spark, 2, 3, 6)
    one = spark.createDataFrame([(1,)], "user int")
    assert [(r["item"], r["rank"]) for r in recommend.recommend_from(uf, vf, one, 5).orderBy("rank").collect()] and recommend.recommend_from(uf, vf, one, 5).count() == 2
    assert recommend.recommend_from(uf, vf, one.limit(0), 5).collect() == []
    assert recommend.recommend_from(uf, vf.limit(0), one, 5).collect() == []


def test_plan_does_not_grow_with_users(spark):
    uf, _ = factors(spark, 300, 4, 7)
    vf, _ = factors(spark, 300, 4, 8)

    def lines(m):
        users = spark.range(m).select(F.col("id").cast("int").alias("user"))
        return recommend.recommend_from(uf, vf, users, 2, 10)._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert lines(300) == lines(5)


def test_half_step_equals_a_plain_solve(spark):
    """The user factors after a fit solve the implicit normal equations of the last item factors."""
    r = np.random.default_rng(0)
    data = [(int(u), int(i), float(r.integers(1, 9))) for u in range(25) for i in r.choice(18, 6, replace=False)]
    reg, alpha = 0.05, 2.0
    model = recommend.fit_als(spark.createDataFrame(data, "user int, item int, rating double"), rank=3, max_iter=4, reg=reg, alpha=alpha, seed=1)
    users = {x.id: np.array(x.features, dtype=float) for x in model.userFactors.collect()}
    items = {x.id: np.array(x.features, dtype=float) for x in model.itemFactors.collect()}
    # Item factors are solved before user factors in every iteration.
    y = np.array(list(items.values()))
    for u, x in users.items():
        mine = [(items[i], c) for w, i, c in data if w == u]
        a = y.T @ y + sum(alpha * c * np.outer(f, f) for f, c in mine) + reg * len(mine) * np.eye(3)
        b = sum((1 + alpha * c) * f for f, c in mine)
        assert np.allclose(np.linalg.solve(a, b), x, rtol=2e-3, atol=2e-4)
