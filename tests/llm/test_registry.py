"""The packages' queries against their SQL on the smallest tables."""

import pytest

from tessera.llm.registry import QUERIES, SQL
from tests.test_entry import SPARK_TO_DUCK, _canon, duck  # noqa: F401


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES if k != "pipeline") == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, sf_small, name):  # noqa: F811
    df = QUERIES[name](spark, sf_small)
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == types[f.name], f.name
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(cols, cur.fetchall())


def test_whole_tables(spark, sf_small):
    for name, fn in QUERIES.items():
        table = {"op1_warc": "pages", "op9_urls": "pages", "op11_codes": "embeddings"}.get(name, "documents")
        if name not in ("op3_packing", "op12_nearest", "pipeline"):
            assert fn(spark, sf_small).count() == spark.read.parquet(f"{sf_small}/{table}.parquet").count(), name
