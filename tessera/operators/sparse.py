"""Wide one-hot encodings and z-scores that stay sparse.

A categorical column with thousands of values would make every row an array of that many
numbers.  Here rows are ML vectors that hold their non-zero entries only:

* one-hot blocks come from ``OneHotEncoder`` and ``VectorAssembler`` on category indexes;
* moments count absent positions as zeros (``Summarizer``);
* a z-score is ``x / s - m / s``.  Only the scaling is applied to the rows; the offset
  ``m / s``, one vector for the whole table, is kept beside them.  Distances between rows,
  and of rows to centres, do not change when all are shifted by one offset, so k-means
  fits, assignments and distances work on the scaled rows, and centres are shifted back
  for display (``Scaling.shifted``);
* distances to a centre sum over a row's entries only: the rest of the centre is known
  from its length.

Vectors and models travel as objects, never as literals in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators.features import category_index, index_expr, small_categories
from tessera.operators.keys import hot_lookup_join, spread

#: Products of a row's entries with all centres that a task holds at once.
MAX_CELLS = 4_000_000


def sparse_one_hot(df: DataFrame, features_col: str, cat_cols: Sequence[str], indexes: dict | None = None, position: int = 1) -> tuple[DataFrame, dict]:
    """E4 without wide rows: ``features_col`` becomes a vector of the numeric features with one-hot blocks at ``position``.

    Categories are numbered in ascending order as in ``features.one_hot``, and positions are the same.  A column of up
    to 10,000 values is looked up in a list, others in their index table, joined with frequent values spread.  A NULL or
    unseen category fails the job.  Returns the frame and the indexes used, which encode other data alike.
    """
    indexes = dict(indexes or {})
    missing = [c for c in cat_cols if c not in indexes]
    if missing:
        small = small_categories(df, missing)
        for c in missing:
            indexes[c] = small[c] if small is not None else category_index(df, c, "index")
    out, sizes = df, []
    for j, c in enumerate(cat_cols):
        enc, at = indexes[c], f"_at{j}"
        if isinstance(enc, list):
            found, n = index_expr(c, enc), len(enc)
            out = out.withColumn(at, F.when(found.isNull() | (found < 0), X.fail("unseen category")).otherwise(found).cast("double"))
        else:
            n = enc.count()
            out = hot_lookup_join(out, enc.select(F.col(c).alias(f"_key{j}"), F.col("index").alias(at)), c, f"_key{j}", "left").drop(f"_key{j}")
            out = out.withColumn(at, F.when(F.col(at).isNull(), X.fail("unseen category")).otherwise(F.col(at)).cast("double"))
        sizes.append(n)
    f = F.col(features_col)
    out = out.withColumn("_head", array_to_vector(F.slice(f, 1, position)))
    out = out.withColumn("_tail", array_to_vector(F.slice(f, F.lit(position + 1), F.greatest(F.size(f) - position, F.lit(0)))))
    blocks = [f"_block{j}" for j in range(len(cat_cols))]
    if cat_cols:
        encoder = OneHotEncoder(inputCols=[f"_at{j}" for j in range(len(cat_cols))], outputCols=blocks, dropLast=False, handleInvalid="error")
        # The encoder learns nothing but the number of categories: the greatest index.
        model = encoder.fit(df.sparkSession.createDataFrame([tuple(float(n - 1) for n in sizes)], [f"_at{j}" for j in range(len(cat_cols))]))
        out = model.transform(out)
    width = out.select(F.size(f).alias("n")).limit(1).collect()
    out = _sized(_sized(out, "_head", position), "_tail", (width[0]["n"] if width else position) - position)
    out = VectorAssembler(inputCols=["_head", *blocks, "_tail"], outputCol="_assembled").transform(out)
    gone = ["_head", "_tail", *blocks, *[f"_at{j}" for j in range(len(cat_cols))]]
    return out.drop(features_col, *gone).withColumnRenamed("_assembled", features_col), indexes


def _sized(df: DataFrame, col: str, n: int) -> DataFrame:
    """Declare a vector column's width, which the assembler would otherwise look up in the data."""
    return df.withColumn(col, F.col(col).alias(col, metadata={"ml_attr": {"num_attrs": n}}))


@dataclass(frozen=True)
class Scaling:
    """Population moments of sparse rows: ``scale`` is 1 / stdev (1 where that is 0), ``offset`` mean * scale."""

    scale: np.ndarray
    offset: np.ndarray

    def apply(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        """Rows times ``scale``: the z-score without its offset, so absent entries stay absent."""
        product = ElementwiseProduct(scalingVec=Vectors.dense(self.scale), inputCol=features_col, outputCol="_scaled")
        return product.transform(df).drop(features_col).withColumnRenamed("_scaled", features_col)

    def shifted(self, centers: Sequence[Sequence[float]]) -> np.ndarray:
        """Centres of scaled rows as centres of z-scores."""
        return np.asarray(centers) - self.offset


def scaling(df: DataFrame, features_col: str = "features") -> Scaling:
    """Moments in one aggregate; absent entries count as zeros."""
    row = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(features_col)).alias("s")).first()["s"]
    n, mean = row["count"], row["mean"].toArray()
    # A variance of rounding size is none: a constant column is centred only.
    var = row["variance"].toArray() * ((n - 1) / n if n else 0.0)
    sd = np.sqrt(np.where(var > 1e-18 * (1 + mean * mean), var, 0.0))
    scale = np.where(sd > 0, 1 / np.where(sd > 0, sd, 1.0), 1.0)
    return Scaling(scale, mean * scale)


def fit_sparse_kmeans(df: DataFrame, k: int, tol: float = 1e-6, max_iter: int = 20, seed: int = 0, features_col: str = "features") -> KMeansModel:
    """L17 on sparse rows as they are."""
    rows = spread(df.select(F.col(features_col).alias("features"))).persist()
    try:
        return KMeans(k=k, tol=tol, maxIter=max_iter, seed=seed).fit(rows)
    finally:
        rows.unpersist()


def nearest_sparse(centers: np.ndarray, counts: np.ndarray, index: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre (ties to the lowest id) and squared distance of rows given by their entries, row after row."""
    norm = (centers * centers).sum(axis=1)
    across = np.ascontiguousarray(centers.T)
    own, d2 = np.empty(len(counts), np.int32), np.empty(len(counts))
    ends = np.cumsum(counts)
    starts = ends - counts
    step = max(1, MAX_CELLS // max(1, len(centers) * max(1, int(counts.max(initial=1)))))
    for lo in range(0, len(counts), step):
        hi = min(lo + step, len(counts))
        a, b = starts[lo], ends[hi - 1]
        c = across[index[a:b]]
        part = (value[a:b, None] - c) ** 2 - c * c
        full = counts[lo:hi] > 0
        total = np.zeros((hi - lo, len(centers)))
        if full.any():
            total[full] = np.add.reduceat(part, (starts[lo:hi] - a)[full], axis=0)
        total += norm
        own[lo:hi] = total.argmin(axis=1)
        d2[lo:hi] = np.maximum(total[np.arange(hi - lo), own[lo:hi]], 0.0)
    return own, d2


def sparse_distances(df: DataFrame, centers: Sequence[Sequence[float]], features_col: str = "features") -> DataFrame:
    """L19/L21 on sparse rows: add ``cluster`` and ``distance`` to the nearest centre (all in the rows' own space)."""
    table = np.asarray(centers, dtype=float)

    @F.arrow_udf("struct<cluster: int, distance: double>")
    def nearest(kind: pa.Array, index: pa.Array, value: pa.Array) -> pa.Array:
        sizes = np.diff(value.offsets.to_numpy())
        values, dense = value.flatten().to_numpy(zero_copy_only=False), kind.to_numpy() == 1
        if dense.any():  # a dense row holds every position
            given = index.to_pylist()
            at = np.concatenate([np.arange(n) if d else np.array(i, np.int64) for d, n, i in zip(dense, sizes, given, strict=True)] or [np.empty(0, np.int64)])
        else:
            at = index.flatten().to_numpy(zero_copy_only=False)
        own, d2 = nearest_sparse(table, sizes, at, values)
        return pa.StructArray.from_arrays([pa.array(own), pa.array(np.sqrt(d2))], names=["cluster", "distance"])

    entries = F.unwrap_udt(F.col(features_col))
    found = nearest(entries["type"].cast("int"), entries["indices"], entries["values"])
    return df.withColumn("_near", found).select(*[c for c in df.columns if c not in ("cluster", "distance")], "_near.cluster", "_near.distance")
