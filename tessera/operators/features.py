"""Feature engineering.

Per-position moments come from one aggregate and are shipped to the tasks as
array literals: their size is the feature width, not the row count.
Category indexes are computed distributed (``dense_index``) and attached with a
size-checked lookup join.  TF-IDF is two aggregations and two joins; the
sizes measured at run time decide how the document frequencies are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators.keys import dense_index, lookup_join
from tessera.operators.stats import column_moments

MAX_WIDTH = 100_000
MAX_LITERAL_CATEGORIES = 10_000
# Rows of up to this many features are scaled by plain arithmetic, compiled with the scan.
MAX_COMPILED_WIDTH = 64
# A term is a run of letters of any script.
WORD = r"\p{L}+"


def moments(df: DataFrame, features_col: str, width: int) -> tuple[list[float], list[float]]:
    """Means and population stdevs per position, one pass; bounded by ``width``."""
    if width > MAX_WIDTH:
        raise ValueError("feature width too large to ship as literals")
    rows = column_moments(df, features_col, width).orderBy("pos").collect()
    return [r["mean"] for r in rows], [r["stdev"] for r in rows]


def zscore(df: DataFrame, features_col: str, means: Sequence[float], stdevs: Sequence[float], out_col: str | None = None) -> DataFrame:
    """``(x − mean) / stdev``, or ``x − mean`` where stdev ≤ 0 (population stdev)."""
    mean_lit = F.array(*[F.lit(float(m)) for m in means])
    sd_lit = F.array(*[F.lit(float(s) if s is not None else 0.0) for s in stdevs])
    centred = F.zip_with(F.col(features_col), mean_lit, lambda x, m: x - m)
    z = F.zip_with(centred, sd_lit, lambda c, s: F.when(s <= 0, c).otherwise(c / s))
    if len(means) <= MAX_COMPILED_WIDTH and None not in means:
        f = F.col(features_col)
        scaled = [(F.get(f, i) - float(m)) / F.lit(float(s)) if s is not None and not s <= 0 else F.get(f, i) - float(m) for i, (m, s) in enumerate(zip(means, stdevs, strict=True))]
        z = F.when(F.size(f) == len(means), F.array(*scaled)).otherwise(z)
    return df.withColumn(out_col or features_col, z)


def category_index(df: DataFrame, col: str, index_col: str = "index") -> DataFrame:
    """Distinct values of ``col`` numbered 0..n−1 in ascending order (distributed); NULL is no category."""
    return dense_index(df.select(col).where(F.col(col).isNotNull()).distinct(), col, index_col)


def small_categories(df: DataFrame, cols: Sequence[str], max_values: int = MAX_LITERAL_CATEGORIES) -> dict[str, list] | None:
    """Sorted distinct values per column when every column has at most ``max_values`` (checked first).

    One pass estimates the cardinalities (HyperLogLog); only if all are small
    does a second pass gather the sorted sets, whose size is then bounded.
    Returns None when any column is too large.
    """
    est = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    if any(est[c] > max_values // 2 for c in cols):
        return None
    row = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in cols]).first()
    out = {c: list(row[c]) for c in cols}
    if any(len(v) > max_values for v in out.values()):
        return None
    return out


def index_expr(col: str, values: Sequence) -> Column:
    """0-based index of ``col`` in a sorted literal list; −1 when absent."""
    return (F.array_position(F.array(*[F.lit(v) for v in values]), F.col(col)) - 1).cast("int")


def one_hot_block(index: Column, n: int) -> Column:
    """An array of ``n`` zeros with 1.0 at ``index``; a missing index fails the job (unseen category)."""
    block = F.array_insert(F.array_repeat(F.lit(0.0), n - 1), index + 1, F.lit(1.0))
    return F.when(index.isNull() | (index < 0), X.fail("unseen category")).otherwise(block)


def one_hot(
    df: DataFrame,
    features_col: str,
    cat_cols: Sequence[str],
    indexes: dict | None = None,
    position: int = 1,
) -> tuple[DataFrame, dict]:
    """Replace categorical columns by one-hot blocks inserted at ``position`` of the features, in order.

    Small category sets (the usual case) become sorted literal lists and the
    index is an ``array_position`` lookup inside codegen; a column with too
    many categories is indexed distributed and attached with a lookup join.
    Both forms number the same categories alike and refuse a NULL value.
    ``indexes`` (value lists or index DataFrames) apply an existing encoding to
    new data; returns the encoded frame and the indexes used.
    """
    indexes = dict(indexes or {})
    missing = [c for c in cat_cols if c not in indexes]
    if missing:
        small = small_categories(df, missing)
        for c in missing:
            indexes[c] = small[c] if small is not None else category_index(df, c, "index")
    out = df
    blocks = []
    for c in cat_cols:
        enc = indexes[c]
        if isinstance(enc, list):
            blocks.append(one_hot_block(index_expr(c, enc), len(enc)))
            continue
        idx = enc.select(F.col(c).alias(f"_k_{c}"), F.col("index").alias(f"_i_{c}"))
        n = idx.count()
        out = lookup_join(out, idx, out[c] == idx[f"_k_{c}"], "left").drop(f"_k_{c}")
        blocks.append(one_hot_block(F.col(f"_i_{c}").cast("int"), n))
    f = F.col(features_col)
    new = F.concat(F.slice(f, 1, position), *blocks, F.slice(f, F.lit(position + 1), F.size(f) - position))
    out = out.withColumn(features_col, new).drop(*[f"_i_{c}" for c in cat_cols if f"_i_{c}" in out.columns])
    return out, indexes


def projection_matrix(width: int, dims: int = 3, seed: int = 0) -> list[list[float]]:
    """``width × dims`` normal matrix, each row scaled to unit length (small, built on the driver)."""
    if width > MAX_WIDTH:
        raise ValueError("feature width too large")
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((width, dims))
    m = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m.tolist()


def random_projection(df: DataFrame, features_col: str, matrix: Sequence[Sequence[float]], prefix: str = "x") -> DataFrame:
    """``features %*% matrix`` → one column per output axis."""
    dims = len(matrix[0])
    cols = []
    for j in range(dims):
        col_lit = F.array(*[F.lit(float(row[j])) for row in matrix])
        dot = F.aggregate(F.zip_with(F.col(features_col), col_lit, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        cols.append(dot.alias(f"{prefix}{j}"))
    return df.select("*", *cols)


def token_arrays(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = WORD) -> DataFrame:
    """(doc, tokens): every ``pattern`` match of the lower-cased whole text, one array per document."""
    return docs.select(id_col, F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(pattern), 0).alias("tokens"))


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = WORD) -> DataFrame:
    """(doc, term) for every ``pattern`` match of the lower-cased whole text."""
    return token_arrays(docs, id_col, text_col, pattern).select(id_col, F.explode("tokens").alias("term"))


def term_runs(toks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc, term, doc_terms, tf) of every row of token arrays, counted as runs of its sorted tokens."""
    s, ends = F.col("_sorted"), F.col("_ends")
    rows = toks.filter(F.size("tokens") > 0).select(id_col, F.size("tokens").alias("doc_terms"), F.sort_array("tokens").alias("_sorted"))
    # Positions (from 1) after which another term, or nothing, follows.
    last = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: ~F.get(s, i - 1).eqNullSafe(F.get(s, i)))
    rows = rows.select(id_col, "doc_terms", s, last.alias("_ends"))
    runs = F.transform(ends, lambda e, k: F.struct(F.get(s, e - 1).alias("term"), (e - F.coalesce(F.get(ends, k - 1), F.lit(0))).cast("long").alias("tf")))
    return rows.select(id_col, "doc_terms", F.inline(runs)).select(id_col, "term", "doc_terms", "tf")


def tfidf(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    total_docs: Column | int | None = None,
    pattern: str = WORD,
) -> DataFrame:
    """``(count in doc / terms in doc) · ln(docs / docs containing term)`` per (doc, term).

    Terms in a document are the size of its token array (no aggregate or join).
    Where no id repeats, a document's terms are counted in its own row, so that only
    the join on the term shuffles (doc, term) rows; rows of one id and length are
    counted together otherwise.  The join carries no broadcast hint: adaptive
    execution chooses from measured sizes and splits the partitions of very common
    terms.  ``total_docs`` defaults to the number of documents.
    """
    toks = token_arrays(docs, id_col, text_col, pattern)
    repeats = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if repeats:
        tf = (
            toks.select(id_col, F.size("tokens").alias("doc_terms"), F.explode("tokens").alias("term"))
            .groupBy(id_col, "term", "doc_terms")
            .agg(F.count(F.lit(1)).alias("tf"))
        )
    else:
        tf = term_runs(toks, id_col)
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_docs = docs.count() if total_docs is None else total_docs
    j = tf.join(df, "term")
    return j.select(id_col, "term", "tf", "doc_terms", "df", X.tfidf_weight("tf", "doc_terms", "df", F.lit(n_docs)).alias("weight"))


def top_terms(weights: DataFrame, n: int = 10, id_col: str = "doc_id") -> DataFrame:
    """The ``n`` heaviest terms of each document (ties by term); a document's terms are bounded by its length."""
    w = Window.partitionBy(id_col).orderBy(F.col("weight").desc(), "term")
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
