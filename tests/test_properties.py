"""Property tests: the missing-aware statistics equal a plain computation on random inputs."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import stats

values = st.one_of(st.none(), st.just(float("nan")), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False))
rows = st.lists(st.tuples(st.lists(values, min_size=3, max_size=3), st.booleans()), min_size=1, max_size=30)


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


@settings(max_examples=12, deadline=None)
@given(rows)
def test_missing_stats_match_python(spark, data):
    df = spark.createDataFrame(data, "scores array<double>, matched boolean")
    got = {(r.matched, r.pos): r for r in stats.missing_stats(df, "scores", width=3, by=["matched"]).collect()}
    for flag in {m for _, m in data}:
        for pos in range(3):
            xs = [s[pos] for s, m in data if m == flag]
            ok = [x for x in xs if x is not None and not math.isnan(x)]
            r = got[(flag, pos)]
            assert r["count"] == len(ok) and r.missing == len(xs) - len(ok)
            mean = sum(ok) / len(ok) if ok else None
            assert _close(r.mean, mean)
            if ok:
                var = sum((x - mean) ** 2 for x in ok) / len(ok)
                assert _close(r.stdev, math.sqrt(var))
                assert r.min == min(ok) and r.max == max(ok)


pairs = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None)
@given(pairs, pairs)
def test_user_auc_matches_pair_form(spark, pos, neg):
    from tessera.operators import evaluate

    p = spark.createDataFrame([(u, float(s)) for u, s in pos], "user int, score double")
    n = spark.createDataFrame([(u, float(s)) for u, s in neg], "user int, score double")
    got = {r.user: r.auc for r in evaluate.user_auc(p, n).collect()}
    users = {u for u, _ in pos} & {u for u, _ in neg}
    assert set(got) == users
    for u in users:
        ps = [s for v, s in pos if v == u]
        ns = [s for v, s in neg if v == u]
        want = sum(1 for a in ps for b in ns if a > b) / (len(ps) * len(ns))
        assert math.isclose(got[u], want)
