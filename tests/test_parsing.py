import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.sources import text


def lines(spark, rows, extra=None):
    if extra:
        return spark.createDataFrame([(r, e) for r, e in zip(rows, extra)], "value string, ord long")
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_header_split_every_file_line(spark):
    df = lines(spark, ["id_1,id_2,a", "1,2,3", "id_1,id_2,b", "4,5,6"])
    data, header = text.split_header(df)
    assert sorted(r.value for r in data.collect()) == ["1,2,3", "4,5,6"]
    assert header.count() == 2


def test_scored_pairs_missing_and_nan(spark):
    df = lines(spark, ["1,2,0.5,?,NaN,1e2,3,4,5,6,7,TRUE", "3,4,1,1,1,1,1,1,1,1,1,false"])
    rows = {r.id1: r for r in text.parse_scored_pairs(df).collect()}
    assert rows[1].scores[:4] == [0.5, None, None, 100.0]
    assert rows[1].matched is True and rows[3].matched is False


@pytest.mark.parametrize(
    "bad",
    ["1,2,x,1,1,1,1,1,1,1,1,true", "1,2,1,1,1,1,1,1,1,1,1,yes", "1,2,1,1,1,1,1,1,1,1,1", "a,2,1,1,1,1,1,1,1,1,1,true", " 1,2,1,1,1,1,1,1,1,1,1,true"],
)
def test_scored_pairs_bad_line_fails(spark, bad):
    with pytest.raises(Exception):
        text.parse_scored_pairs(lines(spark, [bad])).collect()


def test_labeled_label_is_last_minus_one(spark):
    df = lines(spark, ["1.5,2,3,7", "0,0,0,1"])
    rows = sorted(text.parse_labeled(df).collect(), key=lambda r: r.label)
    assert rows[0].label == 0.0 and rows[1].features == [1.5, 2.0, 3.0] and rows[1].label == 6.0
    first2 = text.parse_labeled(df, n_features=2).collect()
    assert all(len(r.features) == 2 for r in first2)


def test_labeled_width_mismatch_fails(spark):
    with pytest.raises(Exception):
        text.parse_labeled(lines(spark, ["1,2,3", "1,2"]), width=3).collect()


def test_mixed_drops_categoricals(spark):
    df = lines(spark, ["0,tcp,http,SF,1,2,normal."])
    r = text.parse_mixed(df).first()
    assert r.label == "normal." and r.features == [0.0, 1.0, 2.0]
    c = text.parse_mixed_categorical(df).first()
    assert (c.c1, c.c2, c.c3) == ("tcp", "http", "SF")


def test_triples_strict(spark):
    ok = text.parse_triples(lines(spark, ["1 2 3"])).first()
    assert (ok.user, ok.item, ok["count"]) == (1, 2, 3)
    for bad in ["1 2", "1 2 x", "1 2 3 4", "1  2 3"]:
        with pytest.raises(Exception):
            text.parse_triples(lines(spark, [bad])).collect()


def test_names_strict_and_lenient(spark):
    df = lines(spark, ["1\tAlpha \r", "2 Beta", "x3\tGamma", "4\t\tDelta\x01", "5\t"])
    lenient = sorted((r.id, r.name) for r in text.parse_names_lenient(df).collect())
    assert lenient == [(1, "Alpha"), (4, "Delta"), (5, "")]
    with pytest.raises(Exception):
        text.parse_names_strict(df).collect()
    strict = text.parse_names_strict(lines(spark, ["7\t  Seven  "])).first()
    assert (strict.id, strict.name) == (7, "Seven")


def test_aliases_empty_token_and_last_wins(spark):
    df = lines(spark, ["\t5", "1\t2", "1\t3", "4\t9"], extra=[0, 1, 2, 3])
    got = sorted(tuple(r) for r in text.parse_aliases(df, order_col="ord").collect())
    assert got == [(1, 3), (4, 9)]


def test_cluster_sample_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0, 2.5]), (3, [-1.0, 0.0])], "cluster int, features array<double>")
    path = str(tmp_path / "sample")
    text.write_lines(text.render_cluster_sample(df), path)
    back = sorted(tuple((r.cluster, tuple(r.features))) for r in text.read_csv_dir(spark, path).collect())
    assert back == [(0, (1.0, 2.5)), (3, (-1.0, 0.0))]
    with pytest.raises(Exception):
        text.write_lines(text.render_cluster_sample(df), path)


def test_xml_roundtrip(spark, tmp_path):
    from tessera.sources import xml

    pages = spark.createDataFrame([(1, "A & B", 0, "<p>x</p> & y"), (2, "C", 0, "plain")], "id long, title string, ns long, text string")
    path = str(tmp_path / "dump")
    xml.write_wiki_pages(pages, path)
    back = sorted(tuple(r) for r in xml.read_wiki_pages(spark, path).select("id", "title", "text").collect())
    assert back == [(1, "A & B", "<p>x</p> & y"), (2, "C", "plain")]


def test_read_lines_partition_hint(spark, tmp_path):
    p = tmp_path / "lines.txt"
    p.write_text("\n".join(str(i) for i in range(100)) + "\n")
    lines = text.read_lines(spark, str(p), min_partitions=5)
    assert lines.rdd.getNumPartitions() >= 5 and lines.count() == 100


def test_pair_lines_are_rendered_once(spark, sf_small):
    from tessera.plans import linkage

    plan = linkage.parsed_pairs(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws(") == 1


@pytest.mark.parametrize("end", ["", "\n", "\r\n", "\u2028"])
def test_a_line_end_does_not_hide_an_empty_field(spark, end):
    df = spark.createDataFrame([("1 2 " + end,)], "value string")
    with pytest.raises(Exception, match="empty field"):
        text.parse_triples(df).collect()
