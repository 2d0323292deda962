"""Decision trees and random forests.

Fits are ``pyspark.ml`` estimators (distributed histogram-based tree
induction).  Categorical features are declared through vector metadata so the
trees split on value sets.  Grids fit each parameter set on one persisted
training set and score with the crosstab-based metrics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators.jobs import map_jobs
from tessera.operators.keys import spread


def decode_one_hot(df: DataFrame, features_col: str, keep: int, blocks: Sequence[tuple[int, int]], out_col: str = "features") -> DataFrame:
    """E5: first ``keep`` features, then for each (start, length) block the index of its 1.0 (−1 if none)."""
    arr = F.col(features_col)
    decoded = F.concat(
        F.slice(arr, 1, keep),
        F.array(*[X.one_hot_position(arr, s, n).cast("double") for s, n in blocks]),
    )
    return df.withColumn(out_col, decoded)


def with_vector(df: DataFrame, features_col: str = "features", categorical: Mapping[int, int] | None = None, width: int | None = None) -> DataFrame:
    """array<double> → ML vector; positions in ``categorical`` are declared nominal with that many values."""
    vec = array_to_vector(F.col(features_col))
    if categorical:
        if width is None:
            raise ValueError("width is needed to declare categorical features")
        nominal = [{"idx": i, "name": f"f{i}", "num_vals": int(n)} for i, n in sorted(categorical.items())]
        numeric = [{"idx": i, "name": f"f{i}"} for i in range(width) if i not in categorical]
        # An empty list of numeric features cannot be read back as attributes.
        attrs = {"numeric": numeric, "nominal": nominal} if numeric else {"nominal": nominal}
        meta = {"ml_attr": {"attrs": attrs, "num_attrs": width}}
        vec = vec.alias(features_col, metadata=meta)
    return df.withColumn(features_col, vec)


def fit_tree(train: DataFrame, impurity: str = "gini", depth: int = 4, bins: int = 100, seed: int = 0) -> DecisionTreeClassificationModel:
    """``trainClassifier(data, classes, categorical, impurity, depth, bins)``."""
    tree = DecisionTreeClassifier(impurity=impurity, maxDepth=depth, maxBins=bins, seed=seed, labelCol="label", featuresCol="features", maxMemoryInMB=1000)
    return _fitted_on(tree, train)


def fit_forest(
    train: DataFrame, trees: int = 20, strategy: str = "auto", impurity: str = "entropy", depth: int = 30, bins: int = 300, seed: int = 0
) -> RandomForestClassificationModel:
    """Random forest (``featureSubsetStrategy='auto'``)."""
    forest = RandomForestClassifier(
        numTrees=trees,
        featureSubsetStrategy=strategy,
        impurity=impurity,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        labelCol="label",
        featuresCol="features",
        # Deep forests split thousands of nodes a level: more nodes per pass over the
        # data, and each row's node kept instead of walking the trees again.
        maxMemoryInMB=1000,
        cacheNodeIds=True,
    )
    return _fitted_on(forest, train)


#: Rows a partition of a tree's training set should hold.
ROWS_PER_PART = 50_000


def dealt_for_trees(train: DataFrame) -> DataFrame:
    """Training rows dealt evenly over the cluster, but no thinner than is worth it.

    For every level each partition sends split statistics of all nodes it saw (nodes x
    bins x classes numbers, hundreds of MB for deep trees), so that partitions of a few
    thousand rows would send far more than they hold.
    """
    train = train.select("label", "features")
    parts = train.agg(F.count(F.lit(1))).first()[0] // ROWS_PER_PART
    return spread(train, max(1, min(parts, train.sparkSession.sparkContext.defaultParallelism)))


def _fitted_on(estimator, train: DataFrame):
    """Fit on rows dealt out and kept meanwhile (a persisted input is taken as it is)."""
    if train.is_cached:
        return estimator.fit(train)
    rows = dealt_for_trees(train).persist()
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def predictions(model, df: DataFrame) -> DataFrame:
    """(label, prediction) rows."""
    return model.transform(df).select("label", "prediction")


def tree_text(model) -> DataFrame:
    """The model's debug string as one row."""
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(model.toDebugString,)], "text string")


def _acc(model, df: DataFrame) -> float:
    return predictions(model, df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def grid(
    train: DataFrame,
    cv: DataFrame,
    fit,
    impurities: Sequence[str] = ("gini", "entropy"),
    depths: Sequence[int] = (1, 20),
    bins: Sequence[int] = (10, 300),
    parallel: int = 1,
) -> DataFrame:
    """Train and cv accuracy of every (impurity, depth, bins), best cv (then train) first.

    ``parallel`` > 1 fits that many parameter sets at once (concurrent jobs).
    """
    train = dealt_for_trees(train).persist()
    cv = cv.select("label", "features").persist()

    def one(params):
        imp, d, b = params
        m = fit(train, impurity=imp, depth=d, bins=b)
        return (imp, int(d), int(b), float(_acc(m, train)), float(_acc(m, cv)))

    try:
        rows = map_jobs(one, product(impurities, depths, bins), parallel)
    finally:
        train.unpersist()
        cv.unpersist()
    spark = train.sparkSession
    df = spark.createDataFrame(rows, "impurity string, depth int, bins int, train_accuracy double, cv_accuracy double")
    return df.orderBy(F.col("cv_accuracy").desc(), F.col("train_accuracy").desc(), "impurity", "depth", "bins")


def one_vector(values: str, sep: str = ",") -> DataFrame:
    """One row with the vector of comma-separated values."""
    row = SparkSession.getActiveSession().createDataFrame([(values,)], "value string")
    arr = F.transform(F.split("value", sep), lambda s: X.strict_double(s))
    return row.select(array_to_vector(arr).alias("features"))


def predict_values(model, values: str, sep: str = ",") -> DataFrame:
    """Parse one comma-separated vector and predict it."""
    df = one_vector(values, sep)
    return model.transform(df).select(F.lit(values).alias("input"), "prediction")
