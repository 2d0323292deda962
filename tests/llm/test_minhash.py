import random

import numpy as np
import pytest

from tessera.llm import minhash as M


def brute(rows, shingle, percent=80):
    """(n_shingles, component id) per row by comparing all pairs."""
    sets = [M.shingle_strings((t or "").encode(), shingle) for _, t in rows]
    n = len(rows)
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(n):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                label[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(len(s), least.get(root(k)) if s else rows[k][0]) for k, s in enumerate(sets)]


def near_copies(rnd, n_groups=12):
    rows, next_id = [], 0
    for _ in range(n_groups):
        base = [rnd.choice("abcdefghijklmnop") * rnd.randint(1, 4) + str(rnd.randint(0, 9)) for _ in range(rnd.choice([1, 2, 3, 6, 12, 40, 120]))]
        for _ in range(rnd.randint(1, 9)):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(words) // 12))):
                words[rnd.randrange(len(words))] = f"edit{rnd.randint(0, 99)}"
            rows.append((next_id, rnd.choice([" ", "\n", "\t "]).join(words)))
            next_id += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shingle", [2, 5])
def test_matches_brute_force(spark, shingle):
    rnd = random.Random(shingle)
    rows = near_copies(rnd)
    rows += [(900, None), (901, ""), (902, " \n"), (None, "only null id here"), (None, rows[0][1]), rows[0], (903, rows[1][1].upper()), (903, "another text, same id"), (904, "w " * 30_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, kept int")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in M.components(df, shingle=shingle).collect()), key=repr)
    want = sorted(((i, n, c, c == i) for (i, _), (n, c) in zip(rows, brute(rows, shingle), strict=True)), key=repr)
    assert got == want


def test_chain_links_reach_the_smallest_id(spark):
    # Neighbours are linked, the ends are far apart: stars alone would not join them all.
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - k, " ".join(words[8 * k : 8 * k + 120])) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in M.components(df, shingle=2).collect()}
    assert got == {i: c for (i, _), (_, c) in zip(rows, brute(rows, 2), strict=True)}
    assert len(set(got.values())) == 1


def test_odd_members_of_a_bucket_find_each_other(spark):
    # Copies of one text with nested edits: some are linked to each other but not to the centre.
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    rows = [(1000, " ".join(base))] + [(2000 + k, " ".join(base[: 99 - k % 3]) + f" tail{k}") for k in range(30)]
    for k in range(12):
        words = list(base)
        for at in rnd.sample(range(100), 14):
            words[at] = f"v{k // 3}-{at}"
        for c in range(4):
            own = list(words)
            for at in rnd.sample(range(100), c):
                own[at] = f"own{k}-{c}"
            rows.append((10 * k + c, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in M.components(df, shingle=2).collect()}
    assert got == {i: c for (i, _), (_, c) in zip(rows, brute(rows, 2), strict=True)}
    assert len(set(got.values())) > 3


def test_needed_differences_bound():
    # The join of ``across`` must meet every linked pair whose first text is not linked to the centre.
    rnd = random.Random(12)
    met = 0
    for _ in range(4000):
        c = set(range(rnd.randint(3, 20)))
        pool = [100 + i for i in range(6)]
        x, y = ({e for e in c if rnd.random() > 0.2} | set(rnd.sample(pool, rnd.randint(0, 5))) for _ in range(2))
        if not x or not y or 100 * len(x & c) >= 80 * len(x | c) or 100 * len(x & y) < 80 * len(x | y) or x == y:
            continue
        added, removed = sorted(y - c), sorted(c - y)
        part = [(e, 0) for e in added] + [(e, 1) for e in removed]
        mine = {(e, 0) for e in x - c} | {(e, 1) for e in c - x}
        excess = 100 * len(c - x) + 80 * len(x - c) - 20 * len(c)
        own = 100 * len(removed) + 80 * len(added)
        assert any(e in mine and excess + own <= (len(part) - at) * 180 for at, e in enumerate(part))
        met += 1
    assert met > 50


def test_signature_misses_are_rare():
    rnd = random.Random(5)
    missed = 0
    for n in (4, 9, 20, 100, 400):
        for _ in range(60):
            base = [f"{rnd.random()}" for _ in range(n + 1)]
            other = list(base)
            cut = max(1, n // 10)
            other[-cut:] = [f"{rnd.random()}" for _ in range(cut)]
            a, b = (M.shingle_hashes(" ".join(x).encode(), 2) for x in (base, other))
            if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
                missed += not np.any(M.band_keys(a) == M.band_keys(b))
    assert missed == 0


def test_densification_fills_every_bin_for_one_shingle():
    a = M.band_keys(M.shingle_hashes(b"one", 2))
    assert len(set(a.tolist())) == M.BANDS and (a == M.band_keys(M.shingle_hashes(b"ONE", 2))).all()


def test_connected_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(30)]
    df = spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in M.connected(df).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    roots = {x: r for x, r in label.items() if x != r}
    assert {x: r for x, r in got.items() if x != r} == roots


def test_drop_keeps_one_and_the_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text, "en"), (1, text + " x", "en"), (2, "other words entirely here and there", None), (4, None, "fr"), (None, text, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    out = M.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] for r in out.collect())) == [1, 2, 4]
    assert M.drop_near_duplicates(df.limit(0)).count() == 0


def test_candidates_grow_with_documents_not_pairs(spark, monkeypatch):
    """One template, four random words changed in every document: hardly any two are linked."""
    from tessera.llm import minhash as M

    counts = {}
    real = M.across
    monkeypatch.setattr(M, "across", lambda *a: (lambda out: (counts.__setitem__(size, out.count()), out)[1])(real(*a)))
    rnd = random.Random(5)
    base = [f"t{i}" for i in range(60)]
    for size in (150, 300, 600):
        rows = []
        for i in range(size):
            words = list(base)
            for at in rnd.sample(range(60), 4):
                words[at] = f"r{rnd.randrange(10**6)}"
            rows.append((i, " ".join(words)))
        got = {r["doc_id"]: r["component_id"] for r in M.components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
        sets = {i: M.shingle_strings(t.encode(), 2) for i, t in rows}
        parent = {i: i for i in sets}

        def top(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in sets:
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = sorted((top(i), top(j)))
                    parent[b] = a
        assert got == {i: top(i) for i in sets}
    print(counts)
    assert counts.get(600, 0) < 0.02 * 600 * 599 / 2
