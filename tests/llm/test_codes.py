import math

import duckdb
import numpy as np
import pytest

from tessera.llm import codes as C


def brute(rows, parts, entries, rounds, scale):
    """(id, code, error, label_error) of the kept rows, and the codebooks, with Python integers."""
    kept = [(i, v, c) for i, v, c in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(scale * x) for x in v] for _, v, _ in kept]
    p = len(whole[0]) // parts
    cut = [[w[k * p : (k + 1) * p] for k in range(parts)] for w in whole]
    books = [[c[k] for c in cut[:entries]] for k in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            got = {}
            for c in cut:
                got.setdefault(nearest(c[k], books[k])[1], []).append(c[k])
            for j, xs in got.items():
                books[k][j] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    out = []
    for (i, _, lab), c in zip(kept, cut, strict=True):
        near = [nearest(c[k], books[k]) for k in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in near), sum(d for d, _ in near), lab))
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, e, total[lab]) for i, c, e, lab in out), key=repr), books


def vectors(kind, n, d, seed):
    r = np.random.default_rng(seed)
    if kind == "grid":  # many ties, many equal vectors
        x = r.integers(-2, 3, (n, d)) / 64
    elif kind == "groups":
        x = r.normal(size=(5, d))[r.integers(0, 5, n)] + 0.01 * r.normal(size=(n, d))
    elif kind == "large":
        x = r.normal(size=(n, d)) * 2.0**17
    else:
        x = r.normal(size=(n, d))
    return [[float(np.float32(v)) for v in row] for row in x]


@pytest.mark.parametrize("kind", ["grid", "groups", "large", "plain"])
def test_equals_brute_force(spark, kind):
    rows = [(i, v, i % 3 if i % 7 else None) for i, v in enumerate(vectors(kind, 260, 8, 3))]
    rows += [(7, rows[5][1], 1), (None, rows[9][1], None), (500, None, 1), (501, [None] * 8, 1), (502, [float("nan")] * 8, 1), (503, [math.inf] * 8, 2), (504, [], 2)]
    rows += [(600, rows[3][1], 9)] * 130  # a third of all rows are one vector
    df = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], "vec_id long, embedding array<float>, label int, code string").repartition(5)
    got, books = C.vector_codes(df, parts=4, entries=24, rounds=3, scale=1024, chunk=90, leaf=8)
    want, want_books = brute(rows, 4, 24, 3, 1024)
    assert sorted((tuple(r) for r in got.select("vec_id", "code", "error", "label_error").collect()), key=repr) == want
    assert books.tolist() == want_books


def test_matches_by_pruning_alone():
    # The matcher against all distances, over shapes in which pruning settles nothing, something and everything.
    r = np.random.default_rng(1)
    for n, k, p, spread in ((1, 1, 1, 5), (3, 2, 2, 5), (700, 40, 3, 4), (700, 256, 4, 200), (500, 3, 2, 100000), (300, 7, 5, 0)):
        x, e = (r.integers(-spread, spread + 1, (m, p)) for m in (n, k))
        order = C.grow(x, 16)
        tree = C.Tree(x[order], 16)
        want = ((x[order][:, None] - e[None]) ** 2).sum(axis=2).argmin(axis=1)
        owner, sums, counts = np.full(n, -1), np.zeros((k, p), np.int64), np.zeros(k, np.int64)
        C.Codebook(e).match(tree, owner, None, None)
        assert owner.tolist() == want.tolist()
        C.Codebook(e).match(tree, None, sums, counts)
        assert counts.tolist() == np.bincount(want, minlength=k).tolist()
        assert sums.tolist() == [x[order][want == j].sum(axis=0).tolist() for j in range(k)]


def test_whole_nodes_are_assigned(monkeypatch):
    # Well separated groups never reach the point-by-point comparison.
    monkeypatch.setattr(C.Codebook, "compare", lambda self, parts, q, *_: (_ for _ in ()).throw(AssertionError) if len(q) else None)
    x = np.repeat(np.array([[0, 0], [9000, 0], [0, 9000], [9000, 9000]]), 64, axis=0) + np.random.default_rng(0).integers(0, 9, (256, 2))
    tree = C.Tree(x[C.grow(x, 64)], 64)
    sums, counts = np.zeros((4, 2), np.int64), np.zeros(4, np.int64)
    C.Codebook(np.array([[0, 0], [9000, 0], [0, 9000], [9000, 9000]])).match(tree, None, sums, counts)
    assert counts.tolist() == [64] * 4


def test_edges(spark):
    kind = "vec_id long, embedding array<double>, label string"
    none = spark.createDataFrame([], kind)
    assert C.vector_codes(none)[0].collect() == [] and C.vector_codes(none)[0].columns == ["vec_id", "code", "error", "label_error"]
    one = spark.createDataFrame([(1, [0.5, -0.25, 0.0, 1.0], None)], kind)
    assert [tuple(r) for r in C.vector_codes(one)[0].collect()] == [(1, "00000000", 0, 0)]
    with pytest.raises(Exception, match="one width"):
        C.vector_codes(one.union(spark.createDataFrame([(2, [1.0] * 8, None)], kind)))
    with pytest.raises(ValueError, match="cut into"):
        C.vector_codes(spark.createDataFrame([(2, [1.0] * 6, None)], kind))
    with pytest.raises(ValueError, match="too large"):
        C.vector_codes(spark.createDataFrame([(2, [1e30] * 4, None)], kind))


def test_many_labels_and_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT", 0.05)
    rows = [(i, [float(i % 5), 1.0, 2.0, i / 7], 0 if i % 3 == 0 else i) for i in range(300)]
    got, _ = C.vector_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), entries=8)
    want, _ = brute(rows, 4, 8, 4, 1024)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_sql_equals_brute_force(spark):
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(vectors("grid", 60, 8, 4) + vectors("plain", 40, 8, 4))]
    rows += [(900, None, 1), (901, [float("nan")] + [0.0] * 7, 1)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in rows])
    want, books = brute(rows, 4, 20, 2, 1024)
    got = con.execute(C.sql(entries=20, rounds=2)).fetchall()
    assert sorted((r[:4] for r in got), key=repr) == want
    assert {r[4] for r in got} == {C.digest(np.array(books))}
