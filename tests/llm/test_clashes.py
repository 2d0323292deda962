"""Input columns named like those an operator adds for itself keep their values."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import common, decontaminate, langid, minhash, packing, suffixes, urls

WORDS = [f"w{i}" for i in range(60)]


def with_names(spark, names, rows=6):
    data = [(i, " ".join(WORDS[i % 3 :]) + f" end{i}", *[f"{n}{i}" for n in names]) for i in range(rows)]
    return spark.createDataFrame(data, ["doc_id", "text", *names])


def kept_values(got, names):
    return all(r[n] == f"{n}{r['doc_id']}" for r in got.collect() for n in names)


@pytest.mark.parametrize("odd", ["_computed", "a b", "x.y"])
def test_free_names(spark, odd):
    df = with_names(spark, [odd])
    assert common.free_name("_Computed", df.columns).lower() not in [c.lower() for c in df.columns]
    got = langid.identify(df, {"en": [119]})
    assert got.columns == ["doc_id", "text", odd, "lang_pred", "score"] and all(r[odd].startswith(odd) for r in got.collect())


def test_suffixes(spark):
    names = ["_chunk", "_chunk_", "_cut", "cut", "repeat_spans", "id", "row", "chunk", "a b"]
    df = with_names(spark, names).withColumn("n_chars", F.length("text"))
    got = suffixes.remove_repeats(df)
    assert got.columns == df.columns and got.schema == df.schema and kept_values(got, names)
    assert sum(len(r["text"]) for r in got.collect()) < sum(len(r["text"]) for r in df.collect())
    plain = suffixes.remove_repeats(df.select("doc_id", "text"))
    assert sorted(r["text"] for r in plain.collect()) == sorted(r["text"] for r in got.collect())
    found = suffixes.find_repeats(df.select("doc_id", "text", "_chunk", "a b"))
    assert found.columns == ["doc_id", "text", "_chunk", "a b", "repeat_spans"] and kept_values(found, ["_chunk", "a b"])


def test_minhash(spark):
    names = ["_gone", "_key", "node", "kept", "doc_id_", "text_key"]
    got = minhash.drop_near_duplicates(with_names(spark, names))
    assert got.columns == ["doc_id", "text", *names] and kept_values(got, names) and got.count() == 1


def test_urls(spark):
    names = ["_host", "_path", "_rule", "_says", "_expr", "_digest", "_short", "w", "digest", "short", "rank", "says"]
    df = with_names(spark, names).withColumn("url", F.lit("http://a.org/x/y"))
    rules = spark.createDataFrame([("block", "a.org", "/x")], "rule_verdict string, rule_host string, rule_path string")
    for limit in (1000, 0):
        got = urls.filter_urls(df, rules, max_broadcast_rules=limit)
        assert got.columns == [*df.columns, "host", "path", "rule", "verdict"] and kept_values(got, names)
        assert {(r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == {("a.org", "/x/y", "a.org/x", "block")}


def test_decontaminate(spark):
    names = ["hit_spans_1", "hit_items_1", "hit_spans_", "hit_items_", "_text", "_row", "_spans", "_computed"]
    df = with_names(spark, names)
    items = spark.createDataFrame([("i1", " ".join(WORDS[10:24])), ("i2", " ".join(WORDS[30:45])), (None, " ".join(WORDS[48:60]))], "item_id string, text string")
    whole = decontaminate.find_contamination(df, items)
    blocks = decontaminate.find_contamination(df, items, max_block_words=14)
    for got in (whole, blocks):
        assert got.columns == [*df.columns, "n_words", "hit_spans", "hit_items"] and kept_values(got, names)
    both = [sorted((r["doc_id"], r["hit_spans"], r["hit_items"]) for r in d.collect()) for d in (whole, blocks)]
    assert both[0] == both[1]
    # The item without an id is hit, but not named.
    assert all(items == ["i1", "i2"] and len(spans) == 6 for _, spans, items in both[0])
    out = decontaminate.decontaminate(df, items, max_coverage=0.9)
    assert out.columns == df.columns and kept_values(out, names) and all("w50" not in r["text"] for r in out.collect())


def test_packing(spark):
    names = ["_task", "_rank", "_n", "_before", "_slot", "n", "a b"]
    pieces = with_names(spark, names).withColumn("length", (F.col("doc_id") + 1).cast("long"))
    got = packing.pack(pieces, capacity=10)
    assert got.columns == [*pieces.columns, "sequence_id", "offset"] and kept_values(got, names)


def test_langid_pieces_and_null_ids(spark, tmp_path):
    text = "Über den Wolken,  muß die Freiheit\twohl grenzenlos sein 12 ΟΔΟΣ. " * 3
    whole = langid.grams_of(text)
    for piece in (1, 2, 3, 7, 50):
        codes, counts = langid.grams_of(text, piece)
        assert codes.tolist() == whole[0].tolist() and counts.tolist() == whole[1].tolist()
    rows = [(None, "nur hier gelernt", "de"), (1, "nur hier", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"]) for r in langid.q_langid(spark, str(tmp_path)).collect()}
    assert got[None] == (False, "de") and got[1][1] == "de"
