import random

import corpus_pipeline as C
from pyspark.sql import functions as F
from tessera.llm import decontaminate, minhash, quality, suffixes
from tessera.llm.common import read_table
from tests.llm.test_decontaminate import brute as brute_windows
from tests.llm.test_minhash import brute as brute_near
from tests.llm.test_quality import brute as brute_quality
from tests.llm.test_suffixes import brute as brute_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


SYLLABLES = "an ber cho dra el fin gor hu is jal kem lo mir nat or pel qua rin sto tu vel wes yo zim".split()


def prose(rnd, n):
    return " ".join("".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def documents(rnd, items):
    passage = prose(rnd, 60)
    rows = []
    for i in range(40):
        text = prose(rnd, rnd.randint(60, 200))
        if i % 5 == 1:
            text = f"{text[:200]} {passage} {text[200:]}"
        if i % 7 == 2:
            text = f"{text} {items[i % len(items)][1]}"
        rows.append((i, text))
    rows += [(100 + i, rows[i][1] + (" more words here" if i % 2 else "")) for i in range(10)]
    rows += [(200, "short"), (201, None), (202, ""), (203, "same same same " * 80), (204, rows[4][1].upper())]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, -1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_against_brute_force(spark, tmp_path):
    rnd = random.Random(8)
    items = [(k, prose(rnd, 25)) for k in range(4)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    sf = f"file://{tmp_path}"
    rows = documents(rnd, items)

    docs = frame(spark, rows)
    kept = C.stage_quality(spark, docs, sf)
    assert kept.columns == COLUMNS
    z = __import__("zstandard").ZstdCompressor(level=3)
    want = [(i, t) for i, t in rows if not brute_quality(t)[5] and quality.verdict(t.encode(), quality.QualityParams(), z)[0]]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted(want)
    assert len(want) >= 45

    rows = want
    kept = C.stage_near_duplicates(spark, frame(spark, rows), sf)
    assert kept.columns == COLUMNS
    want = [(i, t) for (i, t), (_, c) in zip(rows, brute_near(rows, 5), strict=True) if c == i]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted(want)
    assert len(want) <= len(rows) - 10

    rows = want
    cut = C.stage_repeated_spans(spark, frame(spark, rows), sf)
    assert cut.columns == COLUMNS
    spans = brute_repeats(rows, C.SPAN_BYTES)
    want = [(i, suffixes.cut_bytes(t.encode(), suffixes.whole_characters(t.encode(), s)).decode()) for (i, t), s in zip(rows, spans, strict=True)]
    got = {r["doc_id"]: r for r in cut.collect()}
    assert sorted((i, r["text"]) for i, r in got.items()) == sorted(want)
    assert any(spans) and all(got[i]["n_chars"] == (len(got[i]["text"]) if s else -1) for (i, _), s in zip(rows, spans, strict=True))

    rows = want
    clean = C.stage_decontaminate(spark, frame(spark, rows), sf)
    assert clean.columns == COLUMNS
    hits = brute_windows(rows, items)
    left = {i for (i, _), (n, hit, _) in zip(rows, hits, strict=True) if len(hit) <= 0.5 * n}
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(got) == left
    assert any(h for _, h, _ in hits)
    assert not any(h for _, h, _ in brute_windows(list(got.items()), items))
    for (i, t), (_, hit, _) in zip(rows, hits, strict=True):
        if i in left and not hit:
            assert got[i] == t

    packed = C.stage_packing(spark, clean, sf)
    assert {r["doc_id"] for r in packed.collect()} == left


def test_run_is_its_stages(spark, sf_small):
    docs = read_table(spark, sf_small, "documents")
    assert docs.columns == COLUMNS and C.ORACLE_SQL is None
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "repeated_spans", "decontaminate", "packing"]
    out = C.run(spark, sf_small)
    good = quality.keep_good(docs)
    single = minhash.drop_near_duplicates(good)
    cut = suffixes.remove_repeats(single, threshold=C.SPAN_BYTES)
    clean = decontaminate.decontaminate(cut, read_table(spark, sf_small, "benchmark"))
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in clean.collect()}
    assert out.agg(F.countDistinct("sequence_id")).first()[0] <= out.agg(F.sum("length")).first()[0] // 4096 + 2


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(1, "x")]).limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, f"file://{tmp_path}")
    assert docs.count() == 0
