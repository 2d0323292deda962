import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import periodic as P


def brute(words, least):
    """All runs: every period tried at every place, smallest period by definition."""
    out = set()
    n = len(words)
    for q in range(1, n // 2 + 1):
        s = 0
        while s < n - q:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e + q - s >= max(least, 2 * q):
                part = words[s : e + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.add((s, e + q - s, q))
            s = max(e, s + 1) if e > s else s + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sample(rnd):
    kind = rnd.randrange(6)
    if kind == 0:
        return [rnd.choice("ab") for _ in range(rnd.randint(0, 60))]
    if kind == 1:
        unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 9))]
        return [rnd.choice("abc") for _ in range(rnd.randint(0, 5))] + (unit * 12)[: rnd.randint(0, 70)] + [rnd.choice("abc") for _ in range(rnd.randint(0, 5))]
    if kind == 2:  # runs of runs
        inner = [rnd.choice("abc") for _ in range(rnd.randint(1, 3))] * rnd.randint(2, 6) + ["x"] * rnd.randint(0, 2)
        return inner * rnd.randint(1, 5)
    if kind == 3:  # Fibonacci and Thue-Morse words hold very many runs
        a, b = "a", "ab"
        for _ in range(rnd.randint(3, 8)):
            a, b = b, b + a
        return list(b)
    if kind == 4:
        return [str(i.bit_count() % 2) for i in range(rnd.randint(0, 130))]
    line = [rnd.choice("abcdefgh") for _ in range(rnd.randint(4, 20))]
    return [w for _ in range(6) for w in (line if rnd.random() < 0.7 else [rnd.choice("abcdefgh") for _ in range(5)])]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least, monkeypatch):
    monkeypatch.setattr(P, "PAIRS", 97)
    rnd = random.Random(least)
    for _ in range(500):
        words = [w.encode() for w in sample(rnd)]
        got = P.find_runs(P.word_ids(words), least) if words else np.empty((0, 3))
        assert [tuple(r) for r in got.tolist()] == brute(words, least), words


def test_grammar_derives_the_text():
    rnd = random.Random(4)
    for _ in range(200):
        words = [w.encode() for w in sample(rnd)]
        if len(words) < 2:
            continue
        ids = P.word_ids(words)
        alphabet = int(ids.max()) + 1
        rules, left = P.re_pair(ids)
        pairs = list(zip(left, left[1:], strict=False))
        assert all(pairs.count(p) < 2 or p[0] == p[1] for p in pairs)  # equal neighbours may overlap
        whole = P.halved(rules, left, alphabet)

        def expand(s, whole=whole, alphabet=alphabet):
            return [s] if s < alphabet else expand(whole[s - alphabet][0]) + expand(whole[s - alphabet][1])

        assert expand(alphabet + len(whole) - 1) == ids.tolist()


def expected(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, 12)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *digest)


def rows():
    rnd = random.Random(7)
    out = [(i, " ".join(sample(rnd))) for i in range(150)]
    out += [(150, None), (151, ""), (152, " \t\n"), (None, "a b " * 20), (None, None), (3, out[3][1]), (3, out[3][1]), (153, "é ü  x " * 9), (-4, "a " * 13)]
    return out


def test_query_and_sql_equal_brute_force(spark, tmp_path):
    data = rows()
    spark.createDataFrame([(i, t, "x", 0) for i, t in data], "doc_id long, text string, start string, collapsed int").write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted((expected(i, t) for i, t in data), key=repr)
    got = P.q_periodic(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(P.SQL).fetchall(), key=repr) == want


def test_clashing_columns_and_collapsed_text(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y", 5, "k")], "doc_id long, text string, period int, `_computed` string")
    got = P.periodic_runs(df)
    assert got.columns == ["doc_id", "text", "_computed", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed"]
    r = got.first()
    assert (r["_computed"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["collapsed"]) == ("k", 1, 1, 15, 3, 5000, "x a b c y")
    assert P.periodic_runs(df.where("doc_id < 0")).collect() == []


def test_long_texts():
    # One word, one long period, and random words: near-linear work, exact results.
    assert P.find_runs(np.zeros(200_000, dtype=np.int64)).tolist() == [[0, 200_000, 1]]
    r = np.random.default_rng(0)
    unit = r.integers(0, 9999, 30_000)
    assert P.find_runs(np.concatenate((np.array([10_001]), unit, unit, unit[:777], np.array([10_002])))).tolist() == [[1, 60_777, 30_000]]
