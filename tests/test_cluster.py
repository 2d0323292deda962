import math

from pyspark.sql import functions as F

from tessera.operators import cluster


def test_assign_is_argmin_with_low_id_ties(spark):
    centers = [[0.0, 0.0], [2.0, 0.0], [0.0, 2.0]]
    pts = [(0, [1.0, 0.0]), (1, [1.9, 0.1]), (2, [0.0, 1.8]), (3, [5.0, 5.0])]
    df = spark.createDataFrame(pts, "id int, features array<double>")
    got = {r.id: r.cluster for r in cluster.assign(df, centers).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 1}
    d = {r.id: r.distance for r in cluster.distance_to_center(df, centers).collect()}
    assert math.isclose(d[0], 1.0) and math.isclose(d[3], math.sqrt(9 + 25))


def test_nth_largest_and_anomalies(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "id int, distance double")
    assert cluster.nth_largest(df, "distance", 3).first().threshold == 7.0
    assert cluster.nth_largest(df, "distance", 100).first().threshold == 0.0
    an = cluster.anomalies(df, 7.0)
    assert sorted(r.id for r in an.collect()) == [8, 9]
    assert [r.id for r in cluster.first_anomalies(an, 1).collect()] == [8]


def test_centers_table_roundtrip(spark):
    centers = [[1.0, 2.0], [3.0, 4.0]]
    assert cluster.centers_from_table(cluster.centers_table(spark, centers)) == centers


def test_kmeans_clusters_in_range_and_label_lines(spark):
    pts = [([float(i % 3) * 10 + (i % 5) * 0.01, 0.0], f"l{i % 2}") for i in range(60)]
    df = spark.createDataFrame(pts, "features array<double>, label string")
    model = cluster.fit_kmeans(df, k=3, seed=1, runs=2)
    a = cluster.assign(df, cluster.centers_from_model(model))
    ks = {r.cluster for r in a.select("cluster").distinct().collect()}
    assert ks <= {0, 1, 2} and len(ks) == 3
    lines = cluster.cluster_label_lines(cluster.cluster_label_counts(a)).collect()
    assert all(len(r.line) >= 27 for r in lines)
    sweep = cluster.k_sweep(df, [2, 3], seed=1).collect()
    assert sweep[1].mean_distance < sweep[0].mean_distance
    par = cluster.k_sweep(df, [2, 3], seed=1, parallel=2).collect()
    assert [(r.k, round(r.mean_distance, 9)) for r in par] == [(r.k, round(r.mean_distance, 9)) for r in sweep]
    ent = cluster.k_sweep_entropy(df, [2, 3], seed=1, parallel=2).collect()
    assert [r.k for r in ent] == [2, 3] and all(r.weighted_entropy >= 0 for r in ent)


def test_distances_match_python(spark):
    import random

    rnd = random.Random(3)
    centers = [[rnd.random() for _ in range(4)] for _ in range(6)]
    pts = [(i, [rnd.random() for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame(pts, "id int, features array<double>")
    got = {r.id: (r.cluster, r.distance) for r in cluster.distance_to_center(df, centers).collect()}
    for i, p in pts:
        d = [math.dist(p, c) for c in centers]
        k = d.index(min(d))
        assert got[i][0] == k and math.isclose(got[i][1], d[k], rel_tol=1e-12)
