"""Fits over packed ratings: the factors and scores of ``pyspark.ml`` with the same seed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import als_many, recommend


def ratings(spark, users=70, items=40, seed=0):
    r = np.random.default_rng(seed)
    rows = [(int(3 * u - 20), int(7 * i), float(r.integers(-1, 6))) for u in range(users) for i in r.integers(0, 1 + r.integers(3, items), 9)]
    rows += [(5000, int(7 * i), 2.0) for i in range(items) for _ in range(20)]  # one user has most ratings, in repeated pairs
    return spark.createDataFrame(rows, "user int, item int, rating double").repartition(3)


def pack(spark, df, ranks, tasks=2, seed=5):
    return als_many.pack_ratings(df, ranks, lambda one, k: recommend.fit_als(one, k, 0, seed=seed).userFactors, tasks)


def by_id(df):
    rows = sorted(df.collect(), key=lambda r: r["id"])
    return [r["id"] for r in rows], np.array([r["features"] for r in rows], dtype=float)


@pytest.mark.parametrize("sums, row, gathered", [(112 << 20, 1 << 19, 4 << 20), (600, 150, 2000), (0, 100, 800)])
def test_packed_fits_equal_pyspark(spark, monkeypatch, sums, row, gathered):
    for name, value in (("MANY_RATINGS", 50), ("MAX_SUMS", sums), ("ROW_RATINGS", row), ("GATHERED", gathered), ("ITEM_BLOCK", 16)):
        monkeypatch.setattr(als_many, name, value)
    df = ratings(spark).persist()
    packed = pack(spark, df, [3, 5])
    assert packed.rows.count() > (1 if row > 1000 else 5)
    pairs = df.select("user", "item", F.lit(1).alias("p")).union(spark.createDataFrame([(999, 0, 1), (-20, 3, 1)], "user int, item int, p int"))
    for rank, reg, alpha in ((3, 0.1, 1.0), (5, 0.02, 40.0)):
        was = recommend.fit_als(df, rank, 3, reg, alpha, seed=5)
        now = recommend.fit_als(df, rank, 3, reg, alpha, seed=5, packed=packed)
        for side in ("userFactors", "itemFactors"):
            (a, x), (b, y) = by_id(getattr(was, side)), by_id(getattr(now, side))
            assert a == b and np.allclose(x, y, rtol=2e-3, atol=2e-4)
        a, b = (sorted(tuple(r) for r in recommend.als_predictor(m)(pairs).select("user", "item", "p", "score").collect()) for m in (was, now))
        assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[3] for r in a], [r[3] for r in b], rtol=1e-3, atol=1e-3)


def test_a_grid_packs_many_ratings_once(spark, monkeypatch):
    df = ratings(spark)
    pos, neg = df.where("item % 2 = 0").select("user", "item"), df.where("item % 2 = 1").select("user", "item")
    grid = lambda: [tuple(r) for r in recommend.als_grid(df, pos, neg, ranks=(2, 3), regs=(0.1,), alphas=(1.0,), max_iter=2, seed=3, parallel=2).collect()]
    was = grid()
    calls = []
    for name in ("pack_ratings",):
        real = getattr(recommend, name)
        monkeypatch.setattr(recommend, name, lambda *a, real=real: (calls.append(real(*a)), calls[-1])[1])
    monkeypatch.setattr(als_many, "MANY_RATINGS", 50)
    now = grid()
    assert len(calls) == 1 and calls[0] is not None
    assert [r[:3] for r in was] == [r[:3] for r in now] and np.allclose([r[3] for r in was], [r[3] for r in now], atol=2e-3)


def test_other_ratings_are_not_packed(spark, monkeypatch):
    monkeypatch.setattr(als_many, "MANY_RATINGS", 5)
    one = [(i % 4, i % 3, 1.0) for i in range(12)]
    kind = "user int, item int, rating double"
    assert pack(spark, spark.createDataFrame(one, kind), [2]) is not None
    for bad in [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan"))]:
        assert pack(spark, spark.createDataFrame([*one, bad], kind), [2]) is None
    assert pack(spark, spark.createDataFrame(one, "user long, item int, rating double"), [2]) is None
    monkeypatch.setattr(als_many, "MAX_SHIPPED", 16)  # two items of rank 2
    assert pack(spark, spark.createDataFrame(one, kind), [2]) is None
    monkeypatch.undo()
    assert pack(spark, spark.createDataFrame(one, kind), [2]) is None
