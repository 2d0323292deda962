"""k-means clustering, cluster scoring and distance-based anomalies.

Centres are k × d numbers (bounded by the parameters, checked) and travel to
the tasks with the function; assigning a point is an argmin over k distances
computed per Arrow batch in numpy (vectorised, no join, no per-row Python).  Fits use
``pyspark.ml.clustering.KMeans`` (k-means‖ initialisation) on a persisted
input that is dealt evenly over the cluster first: each fit reads it some
hundred times.  Beyond ``MANY_ROWS`` rows all models of a sweep, or all seeds of a fit,
are fitted in the same scans (``kmeans_many``).  Sweeps score all models in one
scan, which carries the centres of every k and sends partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators.jobs import map_jobs
from tessera.operators.keys import spread
from tessera.operators import kmeans_many
from tessera.operators.kmeans_many import Centers, fit_many
from tessera.operators.stats import count_by

MAX_CENTER_VALUES = 1_000_000
# Rows compared with all centres at once, and counts a scoring task holds before it sends them.
BLOCK_ROWS = 4096
MAX_COUNTS = 4_000_000
# Inputs of more rows are fitted by ``fit_many``: all models in the same scans.
MANY_ROWS = 100_000


def centers_from_table(centers: DataFrame, cluster_col: str = "cluster", pos_col: str = "pos", value_col: str = "value") -> list[list[float]]:
    """Collect a (cluster, pos, value) centre table, checking its size first; ids must run 0..k−1."""
    per = centers.groupBy(cluster_col).agg(F.sort_array(F.collect_list(F.struct(pos_col, value_col))).alias("c"))
    size = centers.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if size > MAX_CENTER_VALUES:
        raise ValueError("centre table too large to ship to tasks")
    rows = {r[0]: r["c"] for r in per.collect()}
    if not rows:
        raise ValueError("no centres")
    width = len(next(iter(rows.values())))
    if set(rows) != set(range(len(rows))):
        raise ValueError("centre ids must run from 0 to k-1 without gaps")
    for c in rows.values():
        if [p for p, _ in c] != list(range(width)) or any(v is None for _, v in c):
            raise ValueError("every centre needs one value at every position")
    return [[float(v) for _, v in rows[k]] for k in range(len(rows))]


def centers_from_model(model: KMeansModel | Centers) -> list[list[float]]:
    return [list(map(float, c)) for c in model.clusterCenters()]


def centers_table(spark: SparkSession, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Centres as (cluster, pos, value)."""
    rows = [(i, j, float(v)) for i, c in enumerate(centers) for j, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, pos int, value double")


def _centers_lit(centers: Sequence[Sequence[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])


def _nearest_udf(centers: Sequence[Sequence[float]]):
    cmat = np.asarray(centers, dtype=float)

    @F.pandas_udf("struct<cluster:int,d2:double>")
    def nearest(feats: pd.Series) -> pd.DataFrame:
        x = np.stack(feats.to_numpy()) if len(feats) else np.empty((0, cmat.shape[1]))
        best = np.full(len(x), np.inf)
        own = np.zeros(len(x), dtype="int32")
        # One centre at a time: memory is rows x d, whatever k is.
        for k, c in enumerate(cmat):
            d2 = ((x - c) ** 2).sum(axis=1)
            closer = d2 < best
            best[closer] = d2[closer]
            own[closer] = k
        return pd.DataFrame({"cluster": own, "d2": best})

    return nearest


def _with_nearest(df: DataFrame, centers: Sequence[Sequence[float]], features_col: str, cluster_col: str, d2_col: str) -> DataFrame:
    """Add the nearest centre id and its squared distance (ties to the lowest id).

    Each Arrow batch goes through the centres once, in numpy.  The equivalent SQL (an argmin over k array aggregates) runs as interpreted
    lambdas, and unrolled into plain arithmetic it outgrows codegen; both
    measured several times slower.
    """
    near = _nearest_udf(centers)(F.col(features_col))
    out = df.withColumn("_near", near)
    return out.withColumn(cluster_col, F.col("_near.cluster")).withColumn(d2_col, F.col("_near.d2")).drop("_near")


def assign(df: DataFrame, centers: Sequence[Sequence[float]], features_col: str = "features", out_col: str = "cluster") -> DataFrame:
    """Index of the nearest centre (squared Euclidean; ties to the lowest id)."""
    return _with_nearest(df, centers, features_col, out_col, "_nd2").drop("_nd2")


def distance_to_center(df: DataFrame, centers: Sequence[Sequence[float]], features_col: str = "features", cluster_col: str = "cluster", out_col: str = "distance") -> DataFrame:
    """Distance of each point to its nearest centre, or to the centre named by ``cluster_col`` if present."""
    if cluster_col not in df.columns:
        out = _with_nearest(df, centers, features_col, cluster_col, "_nd2")
        return out.withColumn(out_col, F.sqrt("_nd2")).drop("_nd2")
    own = F.element_at(_centers_lit(centers), F.col(cluster_col) + 1)
    return df.withColumn(out_col, X.euclidean(features_col, own))


def mean_distance(df: DataFrame, centers: Sequence[Sequence[float]], features_col: str = "features") -> DataFrame:
    """Mean distance to the nearest centre."""
    return distance_to_center(df, centers, features_col).agg(F.avg("distance").alias("mean_distance"))


def cluster_label_counts(df: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """(cluster, label, count), sorted."""
    return count_by(df, cluster_col, label_col).orderBy(cluster_col, label_col)


def cluster_label_lines(counts: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """fixed-width ``cluster label count`` lines in sorted order."""
    return counts.orderBy(cluster_col, label_col).select(
        cluster_col, label_col, X.fixed_width_line(cluster_col, label_col, "count").alias("line")
    )


def nth_largest(df: DataFrame, col: str, n: int = 100, at_once: int = 10_000, accuracy: int = 10_000) -> DataFrame:
    """The n-th greatest value (the least one when there are fewer; NULLs do not count, NaN is the greatest).

    Up to ``at_once`` rows are merged in one task as a top-n.  For a larger n two
    approximate quantiles bracket the wanted rank, rows beyond them are counted
    exactly, and the search goes on between them (a share of about 4 / ``accuracy``
    of the rows) until ``at_once`` rows hold the rank.  Each pass is two aggregates
    over ``df``, whose partial results do not grow with the rows.
    """
    v = F.col("threshold")
    values = df.select(F.col(col).alias("threshold")).where(F.col(col).isNotNull())
    wanted, last = n, None
    if wanted > at_once and dict(values.dtypes)["threshold"] in ("float", "double"):
        nan = values.agg(F.count_if(F.isnan(v))).first()[0]
        if nan:
            values = values.where(F.isnan(v) if wanted <= nan else ~F.isnan(v))
            wanted = wanted if wanted <= nan else wanted - nan
    while wanted > at_once:
        total, low, high = values.agg(F.count(F.lit(1)), F.min(v), F.max(v)).first()
        if wanted >= total or low == high:
            return values.agg(F.min(v).alias("threshold"))
        if total != last:
            at = 1 - wanted / total
            low, high = values.agg(F.percentile_approx(v, [max(0.0, at - 2 / accuracy), min(1.0, at + 2 / accuracy)], accuracy)).first()[0]
        # Otherwise the quantiles, rounded to doubles, could not part the rows: the ends go one by one.
        last = total
        a, b = F.lit(low), F.lit(high)
        above, top, inner, bottom = values.agg(F.count_if(v > b), F.count_if(v == b), F.count_if((v > a) & (v < b)), F.count_if(v == a)).first()
        if wanted <= above:
            values = values.where(v > b)
        elif wanted <= above + top:
            return values.where(v == b).agg(F.min(v).alias("threshold"))
        elif wanted <= above + top + inner:
            values, wanted = values.where((v > a) & (v < b)), wanted - above - top
        elif wanted <= above + top + inner + bottom:
            return values.where(v == a).agg(F.min(v).alias("threshold"))
        else:
            values, wanted = values.where(v < a), wanted - above - top - inner - bottom
    return values.orderBy(v.desc()).limit(wanted).agg(F.min(v).alias("threshold"))


def anomalies(df: DataFrame, threshold: float | Column, dist_col: str = "distance") -> DataFrame:
    """Rows strictly farther than the threshold."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.filter(F.col(dist_col) > t)


def first_anomalies(found: DataFrame, n: int = 10, dist_col: str = "distance", ascending: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """T5: the n anomalies nearest the threshold (``ascending``) or the farthest."""
    order = F.col(dist_col).asc() if ascending else F.col(dist_col).desc()
    return found.orderBy(order, *tie).limit(n)


def _fit_vectors(vec: DataFrame, k: int, tol: float, max_iter: int, seed: int, runs: int) -> KMeansModel:
    best = None
    for r in range(runs):
        m = KMeans(k=k, tol=tol, maxIter=max_iter, seed=seed + r, featuresCol="features").fit(vec)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    return best


def _vectors(data: DataFrame, features_col: str) -> DataFrame:
    return data.select(array_to_vector(F.col(features_col)).alias("features"))


def _many_rows(data: DataFrame) -> bool:
    return data.limit(MANY_ROWS + 1).count() > MANY_ROWS


def fit_kmeans(
    data: DataFrame,
    k: int = 2,
    tol: float = 1e-4,
    max_iter: int = 20,
    seed: int = 0,
    runs: int = 1,
    features_col: str = "features",
) -> KMeansModel | Centers:
    """K-means; ``runs`` > 1 keeps the lowest-cost model of that many seeds."""
    if _many_rows(data):
        return min(fit_many(data, {r: (k, seed + r) for r in range(runs)}, tol, max_iter, features_col).values(), key=lambda m: m.cost)
    vec = spread(_vectors(data, features_col)).persist()
    try:
        return _fit_vectors(vec, k, tol, max_iter, seed, runs)
    finally:
        vec.unpersist()


def nearest_block(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre (ties to the lowest id) and squared distance of each row.

    One matrix product ranks the centres; rows whose two best differ by less than
    rounding can explain are compared again term by term, as ``assign`` does, and
    the distance to the chosen centre is always taken term by term.
    """
    norm = (centers * centers).sum(axis=1)
    rank = norm - 2 * (x @ centers.T)
    own = rank.argmin(axis=1).astype(np.int64)
    if len(centers) > 1:
        two = np.partition(rank, 1, axis=1)
        size = (x * x).sum(axis=1) + norm.max()
        for i in np.flatnonzero(~(two[:, 1] - two[:, 0] > 1e-9 * size)):
            own[i] = ((x[i] - centers) ** 2).sum(axis=1).argmin()
    return own, ((x - centers[own]) ** 2).sum(axis=1)


def _packed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Like ``_blocks``, of a batch of stored blocks of near rows."""
    lo = 0
    for _, x in kmeans_many._pieces([batch]):
        yield lo, x
        lo += len(x)


def _blocks(features: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    flat = features.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(features), -1) if len(features) else np.empty((0, 0))
    for lo in range(0, len(x), BLOCK_ROWS):
        yield lo, x[lo : lo + BLOCK_ROWS]


def _shipped(models: Mapping[int, Sequence[Sequence[float]]]) -> dict[int, np.ndarray]:
    out = {int(k): np.asarray(c, dtype=float) for k, c in models.items()}
    if sum(c.size for c in out.values()) > MAX_CENTER_VALUES:
        raise ValueError("centre tables too large to ship to tasks")
    return out


def mean_distances(df: DataFrame, models: Mapping[int, Sequence[Sequence[float]]], features_col: str = "features") -> DataFrame:
    """L22 for many models in one scan: (k, mean distance to the nearest of that model's centres).

    A task sends one row per model: its number of rows and their summed distance.
    """
    return _mean_distances(df.select(features_col), models, lambda batch: _blocks(batch.column(0)))


def _mean_distances(df: DataFrame, models: Mapping[int, Sequence[Sequence[float]]], pieces) -> DataFrame:
    near = kmeans_many.Near(_shipped(models))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, dict.fromkeys(near.models, 0.0)
        for batch in batches:
            for _, x in pieces(batch):
                n += len(x)
                for k, _, c, _ in near.candidates(x):
                    total[k] += float(np.sqrt(nearest_block(x, c)[1]).sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array(list(total.values()), pa.float64())], names=["k", "n", "total"]
            )

    sums = df.mapInArrow(score, "k int, n long, total double")
    return sums.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("mean_distance"))


def cluster_counts(
    df: DataFrame, models: Mapping[int, Sequence[Sequence[float]]], features_col: str = "features", label_col: str = "label"
) -> DataFrame:
    """A26 for many models in one scan: (k, cluster, label, count).

    A task counts per (model, cluster, label) and sends its counts when it ends,
    or earlier when its labels have become so many that they fill ``MAX_COUNTS``.
    """
    kind = dict(df.dtypes)[label_col]
    return _cluster_counts(df.select(features_col, label_col), models, kind, lambda batch: (batch.column(1), _blocks(batch.column(0))))


def _cluster_counts(df: DataFrame, models: Mapping[int, Sequence[Sequence[float]]], kind: str, pieces) -> DataFrame:
    shipped = _shipped(models)
    near = kmeans_many.Near(shipped)
    width = sum(len(c) for c in shipped.values())
    names = ["k", "cluster", "label", "count"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: dict = {}
        held = {k: np.zeros((len(c), 0), dtype=np.int64) for k, c in shipped.items()}

        def sent(label_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            known = pa.array(list(labels), label_type)
            for k, n in held.items():
                cluster, label = np.nonzero(n)
                if len(cluster):
                    cols = [pa.array(np.full(len(cluster), k), pa.int32()), pa.array(cluster, pa.int32()), known.take(pa.array(label)), pa.array(n[cluster, label])]
                    yield pa.RecordBatch.from_arrays(cols, names=names)
                held[k] = np.zeros((len(n), 0), dtype=np.int64)
            labels.clear()

        for batch in batches:
            given, some = pieces(batch)
            found = given.dictionary_encode(null_encoding="encode")
            code = np.array([labels.setdefault(v, len(labels)) for v in found.dictionary.to_pylist()], dtype=np.int64)
            own_label = code[found.indices.to_numpy()] if len(code) else np.empty(0, np.int64)
            for k, c in shipped.items():
                n = np.zeros((len(c), len(labels)), dtype=np.int64)
                n[:, : held[k].shape[1]] = held[k]
                held[k] = n
            for lo, x in some:
                for k, ids, c, _ in near.candidates(x):
                    own, _ = nearest_block(x, c)
                    n = np.bincount(own * len(labels) + own_label[lo : lo + len(x)], minlength=len(ids) * len(labels))
                    held[k][ids] += n.reshape(len(ids), -1)
            if width * len(labels) > MAX_COUNTS:
                yield from sent(given.type)
        if labels:
            yield from sent(given.type)

    parts = df.mapInArrow(count, f"k int, cluster int, label {kind}, count long")
    return parts.groupBy("k", "cluster", "label").agg(F.sum("count").alias("count"))


def entropies(counts: DataFrame) -> DataFrame:
    """A27/A28 for many models: (k, size-weighted mean label entropy of the clusters) from (k, cluster, label, count)."""
    n = F.col("count")
    per = counts.groupBy("k", "cluster").agg(F.sum(n).alias("size"), F.sum(n * F.log(n.cast("double"))).alias("nlogn"))
    # size * entropy = size * ln(size) - sum(n ln n)
    weighted = F.col("size") * F.log(F.col("size").cast("double")) - F.col("nlogn")
    return per.groupBy("k").agg((F.sum(F.greatest(weighted, F.lit(0.0))) / F.sum("size")).alias("weighted_entropy"))


def lloyd(df: DataFrame, centers: Sequence[Sequence[float]], steps: int = 1, features_col: str = "features") -> list[list[float]]:
    """Centres after ``steps`` rounds of k-means from given centres (a centre without points stays).

    Each task sends one row per centre it saw: the number of its points and their
    sum; the driver holds k x d numbers.
    """
    now = _shipped({0: centers})[0]

    def sums(c: np.ndarray):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = np.zeros(len(c), dtype=np.int64), np.zeros(c.shape)
            for batch in batches:
                for _, x in _blocks(batch.column(0)):
                    own, _ = nearest_block(x, c)
                    n += np.bincount(own, minlength=len(c))
                    np.add.at(total, own, x)
            used = np.flatnonzero(n)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used]), pa.array(list(total[used]), pa.list_(pa.float64()))], names=["cluster", "n", "total"])

        return add

    for _ in range(steps):
        parts = df.select(features_col).mapInArrow(sums(now), "cluster int, n long, total array<double>")
        flat = parts.select("cluster", "n", F.posexplode("total").alias("pos", "v"))
        moved = now.copy()
        for r in flat.groupBy("cluster", "pos").agg((F.sum("v") / F.sum("n")).alias("v")).collect():
            moved[r["cluster"], r["pos"]] = r["v"]
        now = moved
    return now.tolist()


def _fits(data: DataFrame, ks: Sequence[int], tol: float, seed: int, parallel: int) -> dict[int, list[list[float]]]:
    """Fitted centres of every k on one persisted input; up to ``parallel`` fits run as concurrent jobs."""
    return dict(map_jobs(lambda k: (int(k), centers_from_model(_fit_vectors(data, k, tol, 20, seed, 1))), ks, parallel))


def _many_fits(blocks: DataFrame, ks: Sequence[int], tol: float, seed: int) -> dict[int, list[list[float]]]:
    return {k: centers_from_model(m) for k, m in kmeans_many.fit_blocks(blocks, {int(k): (int(k), seed) for k in ks}, tol, 20).items()}


def _as_arrays(vec: DataFrame, *others: str) -> DataFrame:
    return vec.select(vector_to_array("features").alias("features"), *others)


def k_sweep(
    data: DataFrame, ks: Sequence[int], tol: float = 1e-6, seed: int = 0, features_col: str = "features", parallel: int = 1
) -> DataFrame:
    """(k, mean distance to nearest centre) for each k; all models are scored in one scan.

    ``parallel`` > 1 submits that many fits at once from driver threads (the
    scheduler interleaves their tasks), as the reference's parallel sweeps do.
    """
    if _many_rows(data):
        blocks = kmeans_many.pack(data, features_col)
        rows = _mean_distances(blocks.select("block", "width", "x"), _many_fits(blocks, ks, tol, seed), _packed).collect()
    else:
        vec = spread(_vectors(data, features_col)).persist()
        try:
            rows = mean_distances(_as_arrays(vec), _fits(vec, ks, tol, seed, parallel)).collect()
        finally:
            vec.unpersist()
    return data.sparkSession.createDataFrame(sorted((r["k"], r["mean_distance"]) for r in rows), "k int, mean_distance double")


def k_sweep_entropy(
    data: DataFrame,
    ks: Sequence[int],
    tol: float = 1e-6,
    seed: int = 0,
    features_col: str = "features",
    label_col: str = "label",
    parallel: int = 1,
) -> DataFrame:
    """(k, size-weighted mean label entropy of the clusters) for each k; all models are scored in one scan."""
    if _many_rows(data):
        blocks = kmeans_many.pack(data, features_col, label_col)
        counts = _cluster_counts(blocks, _many_fits(blocks, ks, tol, seed), dict(data.dtypes)[label_col], lambda batch: (batch.column(3).flatten(), _packed(batch)))
        rows = entropies(counts).collect()
    else:
        vec = spread(data.select(array_to_vector(F.col(features_col)).alias("features"), F.col(label_col).alias("label"))).persist()
        try:
            rows = entropies(cluster_counts(_as_arrays(vec, "label"), _fits(vec, ks, tol, seed, parallel))).collect()
        finally:
            vec.unpersist()
    return data.sparkSession.createDataFrame(sorted((r["k"], r["weighted_entropy"]) for r in rows), "k int, weighted_entropy double")
