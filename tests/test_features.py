import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import features
from tessera.operators.keys import dense_index


def test_zscore_population_and_zero_stdev(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "f array<double>")
    means, sds = features.moments(df, "f", 2)
    assert means == [2.0, 5.0] and sds == [1.0, 0.0]
    z = sorted(tuple(r.f) for r in features.zscore(df, "f", means, sds).collect())
    assert z == [(-1.0, 0.0), (1.0, 0.0)]


def test_one_hot_inserts_blocks_in_order_and_rejects_unseen(spark):
    df = spark.createDataFrame([("b", "x", [1.0, 2.0]), ("a", "y", [3.0, 4.0])], "p string, s string, f array<double>")
    enc, idx = features.one_hot(df, "f", ["p", "s"])
    got = {tuple(r.f) for r in enc.collect()}
    assert got == {(1.0, 0.0, 1.0, 1.0, 0.0, 2.0), (3.0, 1.0, 0.0, 0.0, 1.0, 4.0)}
    new = spark.createDataFrame([("c", "x", [0.0, 0.0])], "p string, s string, f array<double>")
    with pytest.raises(PySparkException):
        features.one_hot(new, "f", ["p", "s"], indexes=idx)[0].collect()


def test_one_hot_distributed_index_path(spark):
    df = spark.createDataFrame([("b", [1.0]), ("a", [3.0])], "p string, f array<double>")
    idx = {"p": features.category_index(df, "p")}
    enc, _ = features.one_hot(df, "f", ["p"], indexes=idx)
    assert {tuple(r.f) for r in enc.collect()} == {(1.0, 0.0, 1.0), (3.0, 1.0, 0.0)}


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 500).select(((F.col("id") * 37) % 1000).alias("k")).repartition(5)
    out = sorted((r.k, r.idx) for r in dense_index(df, "k", partitions=4).collect())
    assert [i for _, i in out] == list(range(500))


def test_projection_rows_unit_length(spark):
    m = np.array(features.projection_matrix(10, 3, seed=1))
    assert np.allclose((m * m).sum(axis=1), 1.0)
    df = spark.createDataFrame([([1.0] + [0.0] * 9,)], "f array<double>")
    r = features.random_projection(df, "f", m.tolist()).first()
    assert np.allclose([r.x0, r.x1, r.x2], m[0])


def test_tfidf_small_corpus(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "b c")], "doc_id long, text string")
    w = {(r.doc_id, r.term): r.weight for r in features.tfidf(docs).collect()}
    assert math.isclose(w[(1, "a")], (2 / 3) * math.log(2))
    assert w[(1, "b")] == 0.0 and math.isclose(w[(2, "c")], 0.5 * math.log(2))
    top = features.top_terms(features.tfidf(docs, total_docs=2), n=1).collect()
    assert {(r.doc_id, r.term) for r in top} == {(1, "a"), (2, "c")}
