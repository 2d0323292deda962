"""Inputs that once lost or changed data."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster, evaluate, features, stats
from tessera.session import scratch_path
from tessera.sources import text, xml


@pytest.mark.parametrize(
    "parse, bad",
    [
        (lambda d: text.parse_labeled(d, width=3), ["1,,3", "1,2,", ",2,3", ""]),
        (lambda d: text.parse_scored_pairs(d, n_scores=2), ["1,2,,1,true", "1,2,1,1,", "1,2,?,,true"]),
        (lambda d: text.parse_mixed(d, width=5), ["1,a,b,c,", "1,a,,c,x", ",a,b,c,x"]),
        (lambda d: text.parse_cluster_sample(d, width=3), ["1,,2", "1,2,", ",1,2"]),
        (lambda d: text.parse_triples(d), ["1  3", "1 2 ", " 1 2"]),
    ],
)
def test_empty_fields_fail(spark, parse, bad):
    for line in bad:
        with pytest.raises(Exception, match="empty field|malformed|MALFORMED"):
            parse(spark.createDataFrame([(line,)], "value string")).collect()


def test_missing_marker_still_means_null(spark):
    r = text.parse_scored_pairs(spark.createDataFrame([("1,2,?,0.5,TRUE",)], "value string"), n_scores=2).first()
    assert (r.id1, r.id2, r.scores, r.matched) == (1, 2, [None, 0.5], True)


def test_a_bad_xml_field_fails(spark):
    path = scratch_path(spark, "bad-xml")
    page = "<page><title>t</title><ns>x</ns><id>1</id><revision><id>1</id><text>a</text></revision></page>"
    spark.createDataFrame([("<mediawiki>" + page + "</mediawiki>",)], "value string").write.text(path)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        xml.read_wiki_pages(spark, path).collect()


def test_centre_table_must_be_whole(spark):
    def table(rows):
        return spark.createDataFrame(rows, "cluster int, pos int, value double")

    assert cluster.centers_from_table(table([(1, 0, 3.0), (0, 0, 1.0), (0, 1, 2.0), (1, 1, 4.0)])) == [[1.0, 2.0], [3.0, 4.0]]
    for rows in ([], [(0, 0, 1.0), (2, 0, 2.0)], [(0, 0, 1.0), (0, 1, 1.0), (1, 0, 1.0)], [(0, 0, None)]):
        with pytest.raises(ValueError):
            cluster.centers_from_table(table(rows))


def test_confusion_matrix_names_fractions_and_texts(spark):
    df = spark.createDataFrame([(0.5, 0.7), (0.7, 0.7), (1.0, 0.5)], "label double, prediction double")
    assert evaluate.confusion_matrix(df).columns == ["label", "p0.5", "p0.7", "p1"]
    words = spark.createDataFrame([("ham", "spam"), ("spam", "spam")], "label string, prediction string")
    got = {r[0]: (r["pham"], r["pspam"]) for r in evaluate.confusion_matrix(words).collect()}
    assert got == {"ham": (0, 1), "spam": (0, 1)}


def test_both_one_hot_forms_agree_and_refuse_null(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "c"), (4.0, "a")], "x double, c string")
    df = df.select("x", "c", F.array("x", F.lit(9.0)).alias("features"))
    rows = lambda d: sorted((r.x, tuple(r.features)) for r in d.select("x", "features").collect())
    small = rows(features.one_hot(df, "features", ["c"])[0])
    monkeypatch.setattr(features, "small_categories", lambda *a, **k: None)
    assert rows(features.one_hot(df, "features", ["c"])[0]) == small
    null = df.unionByName(spark.createDataFrame([(5.0, None, [5.0, 9.0])], "x double, c string, features array<double>"))
    with pytest.raises(Exception, match="unseen category"):
        features.one_hot(null, "features", ["c"])[0].collect()
    monkeypatch.undo()
    with pytest.raises(Exception, match="unseen category"):
        features.one_hot(null, "features", ["c"])[0].collect()
    assert sorted((r["c"], r["index"]) for r in features.category_index(null, "c").collect()) == [("a", 0), ("b", 1), ("c", 2)]


def test_wide_moments(spark):
    import time

    width = 2000
    df = spark.range(200).select(F.array([(F.col("id") * k).cast("double") for k in range(4)]).alias("h"), "id")
    df = df.select(F.flatten(F.array_repeat("h", width // 4)).alias("features"))
    t = time.perf_counter()
    got = {r.pos: r for r in stats.column_moments(df, "features", width).collect()}
    assert time.perf_counter() - t < 30 and len(got) == width
    assert got[1997].sum == 19900.0 and got[1997].mean == 99.5 and got[1996].stdev == 0.0
    assert stats.column_moments(df, "features", width + 1).where("pos = 2000").first().sum is None


def test_auc_options_keep_the_same_users(spark):
    pos = spark.createDataFrame([(None, 2.0), (1, 3.0), (1, 1.0)], "user int, score double")
    neg = spark.createDataFrame([(None, 1.0), (1, 2.0)], "user int, score double")
    got = [sorted(map(repr, evaluate.user_auc(pos, neg, skew_safe=s).collect())) for s in (True, False)]
    assert got[0] == got[1] and len(got[0]) == 2


def test_terms_of_any_script(spark):
    d = spark.createDataFrame([(1, "Für Elève 42 世界-x"), (2, None)], "doc_id long, text string")
    assert sorted(r.term for r in features.tokenize(d).collect()) == sorted(["für", "elève", "世界", "x"])


def test_recommendations_equal_the_models_own(spark):
    from tessera.operators import recommend

    rows = [(u, i, float((u * i) % 7 + 1)) for u in range(1, 25) for i in range(1, 30) if (u * 31 + i * 17) % 3]
    model = recommend.fit_als(spark.createDataFrame(rows, "user int, item int, rating double"), rank=4, max_iter=2)
    users = spark.createDataFrame([(3,), (4,), (9,), (9,), (999,)], "user int")
    want = {}
    for r in model.recommendForUserSubset(users, 5).collect():
        want[r.user] = [round(x.rating, 4) for x in r.recommendations]
    for block in (10_000, 2):
        got = {}
        for r in sorted(recommend.recommend(model, users, 5, block=block).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.user, []).append(round(r.score, 4))
        assert got == want
    assert recommend.recommend(model, users.limit(0), 5).count() == 0
