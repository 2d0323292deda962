import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing as P


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer())


def test_word_cache_equals_the_tokenizer(tokenizer):
    rnd = random.Random(1)
    alphabet = "abcXYZ é ñ ß İ ΑΣ 日本 0 12 . , !! ?' 's 've don't - _ \t\n\x0b\x0c\x1c\x85\u00a0\u2003\u0301 e\u0301 <|endoftext|> <|startoftext|>x"
    cache = P.WordCache(P.default_tokenizer())
    for n in range(400):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        assert cache.ids(text.encode()) == ids_of(tokenizer, text)[:-1].tobytes(), repr(text)
    for text in ("Hello, World!", "<|endoftext|>", "a<|endoftext|>b. c", "it's they've I'm", "x" * 5000, "ab. " * 3000):
        assert cache.ids(text.encode()) == ids_of(tokenizer, text)[:-1].tobytes()


def test_full_cache_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(P.WordCache, "LIMIT", 3)
    cache = P.WordCache(P.default_tokenizer())
    text = "one two, three. Four five one two"
    assert cache.ids(text.encode()) == ids_of(tokenizer, text)[:-1].tobytes()


def check(rows, docs, tokenizer, capacity):
    """Every token of every document once; sequences gapless and within capacity."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    want = {}
    for i, t in docs:
        want.setdefault(i, []).append(ids_of(tokenizer, t))
    assert set(by_doc) == set(want)
    for i, texts in want.items():
        pieces = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i])
        expected = sorted(
            (k, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for ids in texts for k, at in enumerate(range(0, len(ids), capacity))
        )
        assert pieces == expected
    for group in by_seq.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq)


def test_round_trip(spark, tokenizer):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice(["river", "town,", "é", "42"]) for _ in range(rnd.choice([0, 1, 5, 30, 200])))) for i in range(200)]
    docs += [(500, None), (501, ""), (None, "no id"), (3, "again"), (3, "again"), (502, "long " * 9000)]
    df = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, length int").repartition(5)
    for capacity in (64, 4096):
        packed = P.pack_documents(df, capacity=capacity, keep_ids=True).cache()
        n = check(packed.collect(), docs, tokenizer, capacity)
        total = sum(len(ids_of(tokenizer, t)) for _, t in docs)
        assert n <= 1.05 * -(-total // capacity) + 1
        made = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in P.build_sequences(packed).collect()}
        for r in packed.collect():
            assert made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tobytes() == bytes(r["ids"])
        packed.unpersist()


def test_plan_places_each_piece_once():
    rnd = np.random.default_rng(0)
    for capacity, n in ((50, 400), (200, 3000), (50, 1), (50, 0)):
        counts = np.bincount(rnd.integers(1, capacity + 1, n), minlength=capacity + 1)
        configs = P.plan(counts, capacity)
        held = np.zeros(capacity + 1, dtype=np.int64)
        for times, content in configs:
            assert times > 0 and sum(length * k for length, k in content) <= capacity
            for length, k in content:
                held[length] += times * k
        assert (held == counts).all()
        bins = sum(t for t, _ in configs)
        big = int(counts[capacity // 2 + 1 :].sum())
        bound = max(-(-int(np.dot(np.arange(capacity + 1), counts)) // capacity), big)
        assert bins <= 1.03 * bound + 1


def test_short_pieces_go_through_the_program():
    n, capacity = 1000, 4096
    short = np.zeros(capacity + 1, dtype=np.int64)
    short[900], short[748] = 2 * n, 3 * n  # 2 * 900 + 3 * 748 = 4044: n sequences, best fit alone makes 1.1 n
    mixed = short.copy()
    mixed[3000], mixed[2000], mixed[40] = 500, 700, 300
    for counts, most in ((short, 1.02 * n), (mixed, 1.02 * (n + 850))):
        configs = P.plan(counts, capacity)
        assert sum(k for k, _ in configs) <= most
        held = np.zeros_like(counts)
        for k, content in configs:
            assert sum(x * c for x, c in content) <= capacity
            for x, c in content:
                held[x] += k * c
        assert (held == counts).all()


def test_price_is_the_best_bounded_knapsack():
    import itertools

    rnd = np.random.default_rng(1)
    for _ in range(30):
        capacity = 12
        counts = rnd.integers(0, 3, capacity + 1)
        counts[0] = 0
        values = rnd.random(capacity + 1)
        got = P.price(values, counts, capacity)
        assert all(k <= counts[n] for n, k in got.items()) and sum(n * k for n, k in got.items()) <= capacity
        best = max(
            (sum(values[n] * k for n, k in enumerate(c)) for c in itertools.product(*[range(int(x) + 1) for x in counts]) if sum(n * k for n, k in enumerate(c)) <= capacity)
        )
        assert abs(best - sum(values[n] * k for n, k in got.items())) < 1e-9


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
