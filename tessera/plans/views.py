"""SQL twins of ``tessera.sources.fixtures`` for the DuckDB oracle.

Each constant is a ``name AS (...)`` common table expression over the given
tables; ``with_views`` prefixes a query with the ones it names.
"""

from __future__ import annotations

PAIRS = """pairs AS (
  SELECT CAST(l_orderkey AS INTEGER) AS id1, CAST(l_partkey AS INTEGER) AS id2,
         [l_quantity, l_extendedprice, CASE WHEN l_discount <> 0 THEN l_discount END, l_tax, o_totalprice,
          p_retailprice, CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS DOUBLE) END, s_acctbal,
          CAST(p_size AS DOUBLE) / 50.0] AS scores,
         l_returnflag = 'R' AS matched
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey)"""

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
         CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS rating, l_orderkey AS k1, CAST(l_linenumber AS BIGINT) AS k2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ALIASES = """canon AS (
  SELECT p_name, p_brand, p_type, min(p_partkey) AS good FROM part GROUP BY p_name, p_brand, p_type),
aliases AS (
  SELECT CAST(p_partkey AS INTEGER) AS bad, CAST(c.good AS INTEGER) AS good
  FROM part JOIN canon c USING (p_name, p_brand, p_type)
  WHERE p_partkey <> c.good AND p_partkey % 101 <> 0)"""

CANONICAL = """canonical AS (
  SELECT r."user", coalesce(a.good, r.item) AS item, r.rating, r.k1, r.k2
  FROM ratings r LEFT JOIN aliases a ON r.item = a.bad)"""

SCORED = """scored AS (
  SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END AS DOUBLE) AS label,
         CAST(CASE WHEN l_quantity < 17 THEN 0.0 WHEN l_tax < 0.04 THEN 1.0 ELSE 2.0 END AS DOUBLE) AS prediction
  FROM lineitem)"""

EMB = """emb AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)"""

CENTERS = """centers AS (
  SELECT label AS cluster, CAST(u.pos - 1 AS INTEGER) AS pos, avg(u.x) AS value
  FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
               unnest(generate_series(1, len(embedding))) AS pos FROM embeddings) u
  GROUP BY label, u.pos),
center_arrays AS (
  SELECT cluster, list(value ORDER BY pos) AS center FROM centers GROUP BY cluster)"""

CORPUS = """corpus AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM documents)"""

ALL = {
    "pairs": PAIRS,
    "ratings": RATINGS,
    "aliases": ALIASES,
    "canonical": CANONICAL,
    "scored": SCORED,
    "emb": EMB,
    "centers": CENTERS,
    "corpus": CORPUS,
}


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(ALL[n] for n in names) + "\n"
