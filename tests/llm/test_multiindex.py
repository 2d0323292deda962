import math

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import multiindex as M

KIND = "vec_id long, embedding array<double>, score string"


def brute(rows, k):
    """Every query's k best other rows by (score descending, id), components added in order."""
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in kept if i is not None and i % 20 == 0}):
        x = min(v for i, v in kept if i == q)
        scored = []
        for i, v in kept:
            if i != q:
                s = 0.0
                for a, b in zip(x, v, strict=True):
                    s += a * b
                scored.append((-s, i is None, i or 0, i))
        out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return out


def found(spark, rows, monkeypatch, **options):
    for name in ("BLOCK", "QUERY_BLOCK", "PER_CELL"):
        monkeypatch.setattr(M, name, options.pop(name, {"BLOCK": 40, "QUERY_BLOCK": 7, "PER_CELL": 6}[name]))
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], KIND).repartition(4)
    got = M.nearest_vectors(df, df.where("vec_id % 20 = 0").selectExpr("vec_id AS id"), **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2])


def cloud(n, d, seed, groups=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d))
    if groups:
        x = r.normal(size=(groups, d))[r.integers(0, groups, n)] + 0.05 * x
    return [[float(v) for v in row] for row in x]


def test_exact_when_nothing_may_be_missed(spark, monkeypatch):
    rows = list(enumerate(cloud(400, 6, 1) + cloud(200, 6, 2, groups=4)))
    rows += [(20, rows[20][1]), (7, rows[9][1]), (None, rows[40][1]), (None, None), (700, None), (720, [0.0] * 6), (740, [None] * 6), (760, [math.nan] * 6), (780, []), (800, [math.inf] * 6)]
    assert found(spark, rows, monkeypatch, k=5, missed=0.0, first=30) == brute(rows, 5)


def test_hot_vector_and_ties(spark, monkeypatch):
    # A third of all rows hold one vector: ties go to the smaller id, and its cell is dealt over many blocks.
    rows = list(enumerate(cloud(200, 4, 3))) + [(1000 + i, [1.0, 2.0, -1.0, 0.5]) for i in range(130)]
    assert found(spark, rows, monkeypatch, k=20, missed=0.0, first=30) == brute(rows, 20)


def test_few_candidates(spark, monkeypatch):
    rows = list(enumerate(cloud(30, 4, 5)))
    assert found(spark, rows, monkeypatch, k=20) == brute(rows, 20)
    assert found(spark, rows[:1], monkeypatch) == []
    assert found(spark, rows[:3], monkeypatch, k=20) == brute(rows[:3], 20)
    assert M.nearest_vectors(spark.createDataFrame([], KIND)).collect() == []
    with pytest.raises(Exception, match="one width"):
        found(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])], monkeypatch)


@pytest.mark.parametrize("scale", ["unit", "mixed"])
def test_recall(spark, scale):
    x = np.array(cloud(3000, 32, 8) + cloud(1500, 32, 9, groups=40))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True)) if scale == "unit" else 1.0
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame([(i, v, "") for i, v in rows], KIND)
    got = M.nearest_vectors(df, df.where("vec_id % 20 = 0").selectExpr("vec_id AS id")).collect()
    ids = np.arange(0, len(x), 20)
    score = x[ids] @ x.T
    score[np.arange(len(ids)), ids] = -np.inf
    best = {(int(q), int(j)) for q, row in zip(ids, np.argsort(-score, axis=1)[:, :20], strict=True) for j in row}
    assert len(got) == len(best)
    assert len(best & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.93 * len(best)


def test_traversal_is_ascending_and_complete():
    r = np.random.default_rng(0)
    index = M.Index(r.normal(size=(8, 3)), r.normal(size=(8, 3)), 1.0)
    d1, d2 = (d[0] for d in index.distances(r.normal(size=(1, 6))))
    seen = list(index.traverse(d1, d2))
    assert [d for d, _ in seen] == sorted(d for d, _ in seen)
    assert sorted(c for _, c in seen) == list(range(64))
    assert all(d == d1[c // 8] + d2[c % 8] for d, c in seen)


def test_layout_bounds_blocks():
    counts = np.array([3, 0, 4, 2, 100, 5, 0, 9])
    start, split = M.layout(counts, 10)
    size = {}
    for c, n in enumerate(counts.tolist()):
        for p in range(split[c]):
            size[start[c] + p] = size.get(start[c] + p, 0) + n / split[c]
    assert max(size.values()) <= 10 and split[4] == 10 and sorted(size) == list(range(len(size)))


def test_pairs_keep_all_ties():
    index = M.Index(np.zeros((1, 1)), np.zeros((1, 1)), 1.0)
    e = np.ones((50, 2))
    i, j, s = M.best_of_pair(index, 3, np.ones((1, 2)), np.array([4]), np.array([np.inf]), np.array([2.0]), e, pa.array([*range(49), None]), np.zeros(50, np.int32))
    assert j.tolist() == [0, 1, 2] and s.tolist() == [2.0] * 3
