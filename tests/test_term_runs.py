"""Terms of a document are counted in its own row; documents of one id are still counted together."""

from collections import Counter

import pytest

from tessera.operators import features

TEXTS = [(1, "b a b c a b"), (2, "a"), (3, ""), (4, None), (None, "c c"), (5, "Ünder ünder x")]


@pytest.mark.parametrize("more", [[], [(1, "x b a b c a"), (2, "a a")]])
def test_counts_equal_those_of_grouped_rows(spark, more):
    docs = spark.createDataFrame(TEXTS + more, "doc_id long, text string").repartition(3)
    want = Counter()
    for i, t in TEXTS + more:
        words = (t or "").lower().split()
        for w in words:
            want[i, w, len(words)] += 1
    out = features.tfidf(docs)
    got = out.collect()
    assert {(r["doc_id"], r["term"], r["doc_terms"]): r["tf"] for r in got} == want and len(got) == len(want)
    assert {r["term"]: r["df"] for r in got} == Counter(w for _, w, _ in want)
    # Without repeated ids no row is shuffled by its document.
    assert ("hashpartitioning(doc_id" in out._jdf.queryExecution().executedPlan().toString()) == bool(more)
