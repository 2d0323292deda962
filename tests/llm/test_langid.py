from pyspark.sql import functions as F

from tessera.llm import langid


def brute_grams(text):
    from collections import Counter

    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    line = " " + " ".join(words) + " " if words else ""
    for i in range(len(line)):
        for n in (1, 2, 3):
            g = line[i : i + n]
            if len(g) == n and g.strip() and not (n == 3 and g[1] == " ") and not (n == 1 and g == " "):
                out[g] += 1
    return out


def pack(g):
    code = 0
    for c in g:
        code = (code << 21) | ord(c)
    return code


def test_grams_match_brute_force():
    for text in ("", "a", "Hello, wörld! ", "x1y  z", "ÀÉ-ß", "日本 語", "aaa aaa"):
        codes, counts = langid.grams_of(text)
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {pack(g): n for g, n in brute_grams(text).items()}


def test_long_text_in_pieces(monkeypatch):
    text = "the river and the town " * 50
    whole = langid.top_grams(text, 50).tolist()
    monkeypatch.setattr(langid, "PIECE", 23)
    assert set(whole[:10]) <= set(langid.top_grams(text, 50).tolist())


def test_edges(spark):
    rows = [(1, "the and of the", "en", "x"), (2, "le la les de", "fr", "x"), (3, None, "en", "x"), (4, "unlabelled", None, "x"), (None, "12 34", "en", "x"), (1, "the and of the", "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    learned = langid.learn_profiles(df, "text", "lang")
    assert sorted(learned) == ["en", "fr"]
    out = langid.identify(df, learned).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    by = {(r["doc_id"], r["text"]): r["lang_pred"] for r in out}
    assert by[(1, "the and of the")] == "en" and by[(2, "le la les de")] == "fr"
    assert by[(3, None)] == "und" and by[(None, "12 34")] == "und"
    assert langid.learn_profiles(df.limit(0), "text", "lang") == {}
    assert {r["lang_pred"] for r in langid.identify(df, {}).collect()} == {"und"}
    assert langid.identify(df.limit(0), learned).count() == 0


def test_equal_distances_go_to_the_smaller_name():
    p = langid.Profiles({"b": [97, 98], "a": [97, 98]}, 300)
    assert p.predict("ab")[0] == "a"


def test_held_out_accuracy(spark, sf_small):
    got = langid.q_langid(spark, sf_small)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang")
    r = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] >= 0.95
