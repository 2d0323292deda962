import hashlib
import random

import pytest

from tessera.llm import suffixes as S


def brute(rows, t):
    first = {}
    ids = [S.LAST if i is None else i for i, _ in rows]
    raws = [(x or "").encode() for _, x in rows]
    for i, raw in zip(ids, raws, strict=True):
        for j in range(len(raw) - t + 1):
            k = raw[j : j + t]
            first[k] = min(first.get(k, S.LAST), i)
    out = []
    for i, raw in zip(ids, raws, strict=True):
        hit = [False] * len(raw)
        for j in range(len(raw) - t + 1):
            if first[raw[j : j + t]] < i:
                hit[j : j + t] = [True] * t
        spans, j = [], 0
        while j < len(hit):
            e = j
            while e < len(hit) and hit[e]:
                e += 1
            if e > j:
                spans += [j, e]
            j = e + 1
        out.append(spans)
    return out


@pytest.mark.parametrize("t", [9, 50])
def test_matches_brute_force_over_many_chunks(spark, t):
    rnd = random.Random(t)
    pool = ["".join(rnd.choice("ab é") for _ in range(rnd.randint(0, 120))) for _ in range(25)] + ["a" * 180, "", "x" * 7]
    rows = []
    for _ in range(150):
        text = "".join(rnd.choice(pool)[rnd.randint(0, 5) :] for _ in range(rnd.randint(1, 3)))
        rows.append((rnd.choice([None, *range(60)]), rnd.choice([None, "", text, text, text, text, text])))
    rows += [(7, pool[3] * 3), (7, pool[3] * 3), (1, pool[3] * 3)]
    df = spark.createDataFrame([(i, x, [1]) for i, x in rows], "doc_id long, text string, repeat_spans array<int>").repartition(4)
    got = sorted(((r["doc_id"], r["text"], r["repeat_spans"]) for r in S.find_repeats(df, threshold=t, chunk_bytes=600).collect()), key=repr)
    assert got == sorted(((i, x, s) for (i, x), s in zip(rows, brute(rows, t), strict=True)), key=repr)


def test_spare_surroundings_are_exact(spark):
    # One hot phrase with a different neighbourhood in every document: more surroundings than pass 2 sends.
    rnd = random.Random(9)
    hot = "the quick brown fox jumps over it"
    rows = [(i, "".join(rnd.choice("xyz") for _ in range(3)) + hot + "".join(rnd.choice("xyz") for _ in range(20))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["repeat_spans"] for r in S.find_repeats(df, threshold=36, chunk_bytes=100_000).collect()}
    assert [got[i] for i, _ in rows] == brute(rows, 36)


def test_block_edges(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(1)
    texts = pa.array(["".join(rnd.choice("ab") for _ in range(n)) for n in (500, 0, 49, 50, 800)])
    ids = pa.array(range(5), pa.int64())
    whole = [x.tolist() for x in S.Chunk(ids, texts, 50).anchors()]
    monkeypatch.setattr(S, "BLOCK", 64)
    assert [x.tolist() for x in S.Chunk(ids, texts, 50).anchors()] == whole


def test_removed_text_and_columns(spark):
    shared = "è" * 60
    rows = [(1, "aé" + shared, "en", 62), (2, "bé" + shared + "tail", "fr", 66), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = {r["doc_id"]: tuple(r) for r in S.remove_repeats(df).collect()}
    # The byte before the shared run ends a two-byte character: é ends in A9, so the match starts at è.
    assert out[1] == rows[0] and out[3] == rows[2]
    assert out[2] == (2, "bétail"[:2] + "tail", "fr", 6) or out[2][1].startswith("b") and out[2][3] == len(out[2][1])
    assert S.whole_characters("aéb".encode(), [2, 4]) == [3, 4]


def test_packed_columns_round_trip():
    import numpy as np

    v = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64))
    assert (S.get(S.put(v, True), True) == v).all() and (S.get(S.put(v)) == v).all()
    assert len(S.get(S.put(v[:0], True), True)) == 0


def test_empty_and_sha(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.find_repeats(df).count() == 0
    assert S.cut_bytes(b"abcdef", [1, 3, 5, 6]) == b"ade"
    assert hashlib.sha256(S.cut_bytes(b"", [])).hexdigest() == hashlib.sha256(b"").hexdigest()


def test_passes_sort_each_column_once_and_find_documents_per_block(monkeypatch):
    # Hash tables of all anchors and a document search per byte took most of the time of every pass.
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(3)
    texts = pa.array(["".join(rnd.choice("abc ") for _ in range(rnd.choice([0, 10, 49, 50, 900]))) for _ in range(300)])
    ids = pa.array(range(300), pa.int64())
    asked, doc_of = [], S.Chunk.doc_of
    monkeypatch.setattr(S.Chunk, "doc_of", lambda self, at: asked.append(np.size(at)) or doc_of(self, at))
    chunk = S.Chunk(ids, texts, 50)
    assert len(chunk.anchors()[0]) and max(asked, default=0) == 1
    monkeypatch.setattr(S.np, "unique", None)
    state = S.State(ids, texts, 50, 1)
    assert state.first().tolist() == sorted(set(state.key.tolist()))


@pytest.mark.parametrize("wide", [False, True])
def test_group_min_matches_brute_force(wide):
    import numpy as np

    rnd = np.random.default_rng(5)
    one = rnd.integers(0, 40, 500).astype(np.uint64)
    two = rnd.integers(0, 3, 500).astype(np.uint64) if wide else one * np.uint64(7)
    values = rnd.integers(-50, 50, 500)
    keys, least, back = S.group_min([one, two], values)
    rows = list(zip(one.tolist(), two.tolist(), strict=True))
    want = sorted(set(rows))
    assert list(zip(*(k.tolist() for k in keys), strict=True)) == want
    assert least.tolist() == [min(v for r, v in zip(rows, values.tolist(), strict=True) if r == w) for w in want]
    assert [want[g] for g in back.tolist()] == rows
    none = S.group_min([one[:0], two[:0]], values[:0])
    assert [len(x) for x in (*none[0], *none[1:])] == [0, 0, 0, 0]
