from pyspark.sql import functions as F

from tessera.operators import sampling


def draw(u, j, n_items, seed=0):
    p = 2**31 - 1
    x = ((u * 7919 + seed * 15485863) % p) ** 2 % p
    y = (x + j) * 48271 % p
    z = (y * y % p * 69621 + y) % p
    return (z * z % p * 48271 + z) % p % n_items


def brute_negatives(pos, items, seed=0):
    items = sorted(set(items))
    n_items = len(items)
    by_user = {}
    for u, i in pos:
        by_user.setdefault(u, set()).add(i)
    out = set()
    for u, p in by_user.items():
        got, j = 0, 0
        while j < n_items and got < len(p):
            idx = draw(u, j, n_items, seed)
            if items[idx] not in p:
                out.add((u, items[idx], j))
                got += 1
            j += 1
    return out


def test_negative_samples_equal_uncapped_loop(spark):
    pos = [(u, i) for u in range(1, 8) for i in range(u * 3 % 11, u * 3 % 11 + u)] + [(3, 9), (3, 9)]
    items = list(range(0, 14))
    pdf = spark.createDataFrame(pos, "user int, item int")
    idf = spark.createDataFrame([(i,) for i in items], "item int")
    # A tiny first round and tiny chunks force the extra rounds and the chunked ranking.
    got = sampling.negative_samples(pdf, idf, seed=3, first_draws=lambda n: n, chunk=2)
    assert {tuple(r) for r in got.collect()} == brute_negatives(pos, items, seed=3)


def test_negative_samples_user_with_all_items(spark):
    pdf = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "user int, item int")
    idf = spark.createDataFrame([(0,), (1,), (2,)], "item int")
    assert sampling.negative_samples(pdf, idf).count() == 0


def test_hash_split_stable_and_complete(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("k1"), (F.col("id") % 7).alias("k2"))
    b = sampling.arithmetic_bucket("k1", "k2")
    a1, a2 = sampling.hash_split(df, [0.9, 0.1], bucket=b)
    r1, r2 = sampling.hash_split(df.repartition(7), [0.9, 0.1], bucket=b)
    assert sorted(a2.collect()) == sorted(r2.collect())
    assert a1.count() + a2.count() == 2000
    assert a1.unionByName(a2).distinct().count() == 2000
    parts = sampling.hash_split(df, [0.8, 0.1, 0.1], keys=["k1"], seed=4)
    assert sum(p.count() for p in parts) == 2000


def test_hash_sample_fraction(spark):
    df = spark.range(0, 10000)
    n = sampling.hash_sample(df, 0.05, keys=["id"]).count()
    assert 350 < n < 650


def test_random_forms_seeded(spark):
    df = spark.range(0, 1000)
    assert sampling.bernoulli_sample(df, 0.1, 5).collect() == sampling.bernoulli_sample(df, 0.1, 5).collect()
    parts = sampling.random_split(df, [0.8, 0.2], 5)
    assert parts[0].count() + parts[1].count() == 1000


def test_top_n_by_salted_is_exact(spark):
    from pyspark.sql import Window

    from tessera.operators.recommend import top_n_by

    rows = [(0, i, float(i % 17)) for i in range(400)] + [(1, i, 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, "user int, item int, score double")
    got = sorted((r.user, r.item, r.rank) for r in top_n_by(df, ["user"], "score", 5, ["item"], salts=8).collect())
    w = Window.partitionBy("user").orderBy(F.col("score").desc(), "item")
    want = sorted((r.user, r.item, r.rank) for r in df.withColumn("rank", F.row_number().over(w)).filter("rank <= 5").collect())
    assert got == want


def test_draws_spread_over_the_items(spark):
    for n_items in (1000, 1791):
        users = [*range(1, 40), *[41 + 97 * k for k in range(20)]]
        df = spark.createDataFrame([(u, j) for u in users for j in range(200)], "u int, j int")
        got = df.select("u", "j", sampling.draw_index(F.col("u"), F.col("j"), F.lit(n_items)).alias("i")).collect()
        assert all(r.i == draw(r.u, r.j, n_items) for r in got)
        per_user = {}
        for r in got:
            per_user.setdefault(r.u, []).append(r.i)
        # 200 uniform draws give about 181 (of 1000) and 189 (of 1791) distinct items.
        assert min(len(set(x)) for x in per_user.values()) > 150
        assert len({tuple(x) for x in per_user.values()}) == len(users)
        counts = [0] * n_items
        for r in got:
            counts[r.i] += 1
        mean = len(got) / n_items
        chi2 = sum((c - mean) ** 2 / mean for c in counts)
        assert abs(chi2 - n_items) < 6 * (2 * n_items) ** 0.5


def test_split_loses_no_row(spark):
    rows = [(i, "x") for i in range(3000)] + [(None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "k long, v string")
    for parts in (
        sampling.hash_split(df, [0.9, 0.1], bucket=sampling.arithmetic_bucket("k")),
        sampling.hash_split(df, [0.9, 0.1], bucket=sampling.key_bucket(["k"], modulus=10_000)),
        sampling.hash_split(df, [0.9, 0.1], bucket=sampling.key_bucket(["k"], modulus=10_000), modulus=10_000),
        sampling.hash_split(df, [5, 1, 0, 2], keys=["k"]),
        sampling.random_split(df, [0.5, 0.5], 7),
    ):
        assert sum(p.count() for p in parts) == len(rows)
    assert 0 < sampling.hash_split(spark.range(200_000), [0.0003, 0.9997], keys=["id"])[0].count() < 200


def test_small_fractions(spark):
    import pytest

    df = spark.range(200_000)
    assert 20 < sampling.hash_sample(df, 0.0004, keys=["id"]).count() < 160
    with pytest.raises(ValueError, match="finer"):
        sampling.hash_sample(df, 0.0004, bucket=sampling.arithmetic_bucket("id"))
    with pytest.raises(ValueError, match="finer"):
        sampling.hash_split(df, [0.0003, 1.0], bucket=sampling.arithmetic_bucket("id"))


def test_seeded_random_operators_do_not_depend_on_layout(spark):
    a, b = spark.range(0, 1000, numPartitions=4), spark.range(0, 1000, numPartitions=7)
    ids = lambda d: sorted(r.id for r in d.collect())
    for x, y in zip(sampling.random_split(a, [0.8, 0.2], 3), sampling.random_split(b, [0.8, 0.2], 3)):
        assert ids(x) == ids(y)
    assert ids(sampling.bernoulli_sample(a, 0.1, 5)) == ids(sampling.bernoulli_sample(b, 0.1, 5))
    assert ids(sampling.bernoulli_sample(a, 0.1, 5)) != ids(sampling.bernoulli_sample(a, 0.1, 6))


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    import pytest

    from tessera import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.ensure_checkpoint_dir(Session())


def test_lookup_join_broadcasts_only_small_sides(spark):
    from tessera.operators.keys import is_small, lookup_join

    left = spark.range(0, 1000).withColumnRenamed("id", "k")
    right = spark.range(0, 10).withColumnRenamed("id", "k")
    assert is_small(right) and not is_small(right, max_bytes=1)
    plan = lookup_join(left, right, "k", "inner")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    assert lookup_join(left, right, "k", "inner").count() == 10
