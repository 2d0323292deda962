import random
import re

import pytest

from tessera.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = norm(text)
        if not w:
            continue
        k = min(window, len(w))
        for i in range(len(w) - k + 1):
            windows.setdefault(tuple(w[i : i + k]), set()).update([] if item is None else [str(item)])
    out = []
    for _, text in docs:
        w = norm(text)
        hit, found = set(), set()
        for i in range(len(w)):
            for k in range(1, window + 1):
                names = windows.get(tuple(w[i : i + k])) if i + k <= len(w) else None
                if names is not None:  # an item without an id is hit, but names nothing
                    hit |= set(range(i, i + k))
                    found |= names
        out.append((len(w), hit, sorted(found)))
    return out


def flat(spans):
    return {i for s, e in zip(spans[::2], spans[1::2], strict=True) for i in range(s, e)}


@pytest.mark.parametrize("block", [15, 500_000])
def test_matches_brute_force(spark, block):
    rnd = random.Random(3)
    vocab = ["a", "b", "C", "d9", "é", "x-y", "1", "..."]
    items = [(i % 17, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([4, 5, 9, 10, 11, 25])))) for i in range(20)]
    items += [(None, "a a a"), (99, ""), (98, None), items[0]]
    docs = []
    for i in range(60):
        parts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 30)))]
        parts += [rnd.choice(items)[1] or "" for _ in range(rnd.randint(0, 2))]
        rnd.shuffle(parts)
        docs.append((i % 50, rnd.choice(["\n", " ", " z "]).join(parts)))
    docs += [(None, None), (7, ""), (8, "A" * 10_000), docs[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(d, b, max_block_words=block).collect()
    for r, (n, hit, names) in zip(got, brute(docs, items), strict=True):
        assert (r["n_words"], flat(r["hit_spans"]), r["hit_items"]) == (n, hit, names)


def test_cut_and_drop(spark):
    item = " ".join(f"w{i}" for i in range(20))
    clean = " ".join(f"c{i}" for i in range(40))
    rows = [(1, f"{clean}. {item.upper()}! {clean}", "en", 7), (2, item, "en", 7), (3, clean, None, 5), (4, None, None, None), (5, "", "x", 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, hit_spans string, n_chars long")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r["doc_id"]: r for r in D.decontaminate(d, b).collect()}
    assert sorted(out) == [1, 3, 4, 5]
    assert out[1]["text"] == f"{clean}. ! {clean}" and out[1]["n_chars"] == len(out[1]["text"]) and out[1]["hit_spans"] == "en"
    assert out[3]["text"] == clean and out[3]["n_chars"] == 5 and out[4]["text"] is None


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r["hit_spans"]) for r in D.find_contamination(d, none).collect()] == [()]
    assert D.decontaminate(d.limit(0), none).count() == 0
