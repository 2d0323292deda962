"""Counting, summary and missing-aware statistics.

Every statistic is a built-in aggregate: Spark runs a partial aggregate in each
map task and merges the partials after the shuffle, so a hot key costs one
partial row per task rather than one group held in memory.  Several columns or
array positions are summarised in a single pass (one wide ``agg``), then
unpivoted into long form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import exprs as X


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key (``groupBy(...).count()``, partial + final)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct values (exact, or HyperLogLog++ when ``approx``)."""
    agg = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.agg(agg.alias("n_distinct"))


def _summary(c: Column) -> list[Column]:
    c = X.nan_to_null(c)
    return [
        F.count(c),
        F.count(F.lit(1)) - F.count(c),
        F.avg(c),
        F.stddev_pop(c),
        F.min(c),
        F.max(c),
    ]


_SUMMARY_NAMES = ["count", "missing", "mean", "stdev", "min", "max"]


def _unpivot_wide(wide: DataFrame, keys: Sequence[str], labels: Sequence, label_name: str, label_type: str) -> DataFrame:
    """Turn ``k_i_<stat>`` columns into one row per label with the stat columns."""
    structs = [
        F.struct(
            F.lit(lab).cast(label_type).alias(label_name),
            *[F.col(f"k{i}_{s}").alias(s) for s in _SUMMARY_NAMES],
        )
        for i, lab in enumerate(labels)
    ]
    return wide.select(*keys, F.inline(F.array(*structs)))


def column_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, missing, mean, population stdev, min, max of several columns in one pass.

    NaN and NULL both count as missing.  Output: (by..., column, count, missing, mean, stdev, min, max).
    """
    aggs = []
    for i, c in enumerate(cols):
        for s, e in zip(_SUMMARY_NAMES, _summary(F.col(c))):
            aggs.append(e.alias(f"k{i}_{s}"))
    wide = df.groupBy(*by).agg(*aggs)
    return _unpivot_wide(wide, by, list(cols), "column", "string")


def missing_stats(df: DataFrame, array_col: str, width: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per-position missing-aware statistics of an array column.

    With ``width`` known, one wide aggregate over ``arr[i]`` (no row blow-up);
    otherwise positions come from ``posexplode`` and are grouped.
    Output: (by..., pos, count, missing, mean, stdev, min, max); ``pos`` is 0-based.
    """
    if width is not None:
        aggs = []
        for i in range(width):
            for s, e in zip(_SUMMARY_NAMES, _summary(F.get(F.col(array_col), i))):
                aggs.append(e.alias(f"k{i}_{s}"))
        wide = df.groupBy(*by).agg(*aggs)
        return _unpivot_wide(wide, by, list(range(width)), "pos", "int")
    exploded = df.select(*by, F.posexplode(array_col).alias("pos", "_x"))
    return exploded.groupBy(*by, "pos").agg(*[e.alias(s) for s, e in zip(_SUMMARY_NAMES, _summary(F.col("_x")))])


def feature_contrast(df: DataFrame, array_col: str, flag_col: str, width: int) -> DataFrame:
    """Per position (missing in both classes, mean when flag − mean when not flag), one pass."""
    flag = F.col(flag_col)
    aggs = []
    for i in range(width):
        x = X.nan_to_null(F.get(F.col(array_col), i))
        aggs += [
            (F.count(F.lit(1)) - F.count(x)).alias(f"m{i}"),
            (F.avg(F.when(flag, x)) - F.avg(F.when(~flag, x))).alias(f"d{i}"),
        ]
    wide = df.agg(*aggs)
    structs = [
        F.struct(F.lit(i).alias("pos"), F.col(f"m{i}").alias("missing"), F.col(f"d{i}").alias("mean_diff"))
        for i in range(width)
    ]
    return wide.select(F.inline(F.array(*structs)))


def pair_score(df: DataFrame, array_col: str = "scores", positions: Sequence[int] = (2, 5, 6, 7, 8)) -> Column:
    """Sum of chosen positions, missing counted as 0."""
    terms = [X.null_to_zero(X.nan_to_null(F.get(F.col(array_col), i))) for i in positions]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def score_threshold(df: DataFrame, score_col: str, flag_col: str, thresholds: Sequence[float] = (4.0, 2.0)) -> DataFrame:
    """A10: per class, rows with score >= t for each t.  Output: (threshold, flag, count)."""
    aggs = [F.count_if(F.col(score_col) >= F.lit(float(t))).alias(f"c{i}") for i, t in enumerate(thresholds)]
    wide = df.groupBy(flag_col).agg(*aggs)
    structs = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"c{i}").alias("count")) for i, t in enumerate(thresholds)]
    out = wide.select(flag_col, F.inline(F.array(*structs)))
    return out.filter(F.col("count") > 0).select("threshold", flag_col, "count")


def class_priors(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Share of rows per label; the total is a scalar subquery, so labels never meet in one task."""
    counts = count_by(df, label_col)
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(label_col, "count", (F.col("count") / total).alias("prior"))


def chance_agreement(a: DataFrame, b: DataFrame, label_col: str = "label") -> DataFrame:
    """Σ_c p_a(c)·p_b(c), priors matched by class (not by position)."""
    pa = class_priors(a, label_col).select(label_col, F.col("prior").alias("pa"))
    pb = class_priors(b, label_col).select(label_col, F.col("prior").alias("pb"))
    return pa.join(pb, label_col).agg(F.sum(F.col("pa") * F.col("pb")).alias("chance"))


def column_moments(df: DataFrame, array_col: str, width: int) -> DataFrame:
    """Per position sum, sum of squares, mean and population stdev (one pass).

    Positions are rows of one partial aggregate, so the plan does not grow with
    ``width``; positions that no row has come out with NULL statistics.
    """
    x = F.col("_x")
    per = (
        df.select(F.posexplode(F.slice(array_col, 1, width)).alias("pos", "_x"))
        .groupBy("pos")
        .agg(F.sum(x).alias("sum"), F.sum(x * x).alias("sum_sq"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("stdev"))
    )
    every = df.sparkSession.range(width).select(F.col("id").cast("int").alias("pos"))
    return every.join(per, "pos", "left").select("pos", "sum", "sum_sq", "mean", "stdev")


def entropy(counts: DataFrame, count_col: str = "count", by: Sequence[str] = ()) -> DataFrame:
    """−Σ p·ln p over positive counts (natural log), per group ``by``.

    Uses Σ c·ln c: H = ln N − (Σ c ln c)/N, computed in one aggregate.
    """
    c = F.col(count_col).cast("double")
    pos = counts.filter(F.col(count_col) > 0)
    agg = pos.groupBy(*by).agg(F.sum(c).alias("_n"), F.sum(c * F.ln(c)).alias("_cl"))
    return agg.select(*by, F.col("_n").cast("long").alias("size"), (F.ln("_n") - F.col("_cl") / F.col("_n")).alias("entropy"))


def label_entropy(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A27 over the label distribution of a whole dataset."""
    return entropy(count_by(df, label_col)).select("entropy")


def cluster_entropy(df: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """Σ_cluster size·entropy(labels in cluster) / n."""
    per_cluster = entropy(count_by(df, cluster_col, label_col), by=[cluster_col])
    return per_cluster.agg(
        (F.sum(F.col("size") * F.col("entropy")) / F.sum("size")).alias("weighted_entropy")
    )
