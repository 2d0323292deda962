"""Join and key helpers shared by the operators.

``lookup_join`` broadcasts the lookup side only when the optimizer's size
estimate is under a bound; beyond it the join stays a shuffle join (adaptive
execution may still switch it at runtime from real shuffle sizes, and splits
skewed partitions), with the frequent keys of the left side found in one pass and
spread over many tasks.  ``dense_index`` numbers rows 0..n−1 in key order without
moving all rows into one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.session import ensure_checkpoint_dir

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
#: Share of the rows from which on a join key counts as frequent.
HOT_SHARE = 0.005


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (None when not available, e.g. over Spark Connect)."""
    try:
        # py4j hands back either a Python int or a JVM BigInt; str() covers both.
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate is advisory only
        return None


def is_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "left",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``right`` (the lookup side) to ``left``, broadcasting it only under a checked size.

    ``on`` is a shared column name, a (left column, right column) pair, or a condition.
    Beyond the size a join on columns spreads the left side's frequent keys
    (``hot_lookup_join``).
    """
    small = is_small(right, max_broadcast_bytes)
    if isinstance(on, tuple):
        if not small:
            return hot_lookup_join(left, right, *on, how)
        on = left[on[0]] == right[on[1]]
    elif isinstance(on, str) and not small:
        key = f"_right_{on}"
        return hot_lookup_join(left, right.withColumnRenamed(on, key), on, key, how).drop(key)
    return left.join(F.broadcast(right) if small else right, on, how)


def frequent_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Every non-null key with at least ``share`` of the rows, and few others: at most 2 / ``share`` keys.

    One pass with bounded memory: a task counts keys in a table of 4 / ``share``
    entries and, when it is full, lowers all counts by the least that empties half
    of it (Misra and Gries), which loses at most rows * share / 2 of any key's count.
    """
    size = int(4 / share)
    kind = dict(df.dtypes)[key]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for v in pc.value_counts(batch.column(0)).to_pylist():
                held[v["values"]] = held.get(v["values"], 0) + v["counts"]
            if len(held) > size:
                least = sorted(held.values(), reverse=True)[size // 2]
                held = {k: n - least for k, n in held.items() if n > least}
        values = [None, *held]  # the null entry carries the number of rows
        yield pa.RecordBatch.from_arrays([pa.array(values, batch_type), pa.array([rows, *held.values()], pa.int64())], names=["k", "n"])

    batch_type = to_arrow_type(df.schema[key].dataType)
    keys = df.select(F.col(key).alias("k"))
    found = keys.where("k IS NOT NULL").mapInArrow(count, f"k {kind}, n long").groupBy("k").agg(F.sum("n").alias("n"))
    # The entry without a key counts all rows, so it is among the greatest.
    most = found.orderBy(F.col("n").desc()).limit(int(2 / share) + 1).collect()
    total = sum(r["n"] for r in most if r["k"] is None)
    return [r["k"] for r in most if r["k"] is not None and r["n"] >= max(1, total * share / 2)]


def hot_lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left", share: float = HOT_SHARE, salts: int | None = None) -> DataFrame:
    """An equi-join whose frequent left keys are dealt over ``salts`` tasks, with their lookup rows repeated in each.

    Rows of a frequent (or null) key get a salt from their content and their input
    partition, so a recomputed task deals them the same way; all other rows
    have salt 0.  The result is that of the plain join, whatever the salts; how a
    null key fares follows ``how`` ("left" or "inner").
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins keep their result when lookup rows are repeated")
    hot = frequent_keys(left, left_key, share)
    n = salts or max(2, left.sparkSession.sparkContext.defaultParallelism)
    names = [c for c in left.columns if not c.startswith("_salt")]
    dealt = F.pmod(F.xxhash64(*[F.col(c) for c in names]) + F.spark_partition_id() * 7919, F.lit(n)).cast("int")
    is_hot = F.col(left_key).isNull() | F.col(left_key).isin(hot) if hot else F.col(left_key).isNull()
    one = left.withColumn("_salt", F.when(is_hot, dealt).otherwise(0))
    copies = F.when(F.col(right_key).isin(hot), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    two = right.withColumn("_salt_r", F.explode(copies))
    met = one.join(two, (one[left_key] == two[right_key]) & (one["_salt"] == two["_salt_r"]), how)
    return met.drop("_salt", "_salt_r")


def dense_index_count(df: DataFrame, key: str | Sequence[str], index_col: str = "idx", partitions: int | None = None) -> tuple[DataFrame, int]:
    """Number distinct rows of ``df`` 0..n−1 in ascending ``key`` order (a distributed zipWithIndex); returns (rows, n).

    Rows are range-partitioned and sorted; each row's position inside its
    partition comes from ``monotonically_increasing_id`` (partition id in the
    upper bits, row number in the lower 33 bits).  As in ``zipWithIndex``, only
    the per-partition sizes — one number per partition — reach the driver; their
    prefix sums ship back as a literal array.  The sorted rows are checkpointed
    to the shared checkpoint folder first so every use sees the same
    partitioning, and a lost executor recomputes nothing upstream.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = ordered.select(
        *keys,
        F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("_local"),
    ).checkpoint(eager=True)
    sizes = {r["_pid"]: r["_n"] for r in tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()}
    width = max(sizes, default=-1) + 1
    offsets, acc = [], 0
    for pid in range(width):
        offsets.append(acc)
        acc += sizes.get(pid, 0)
    if not offsets:
        return tagged.select(*keys, F.lit(0).cast("long").alias(index_col)), 0
    off = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_pid") + 1)
    return tagged.select(*keys, (off + F.col("_local")).alias(index_col)), acc


def dense_index(df: DataFrame, key: str | Sequence[str], index_col: str = "idx", partitions: int | None = None) -> DataFrame:
    """``dense_index_count`` without the count."""
    return dense_index_count(df, key, index_col, partitions)[0]


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows evenly over the cluster (or ``partitions``), whatever their values.

    For inputs that an iterative fit reads again and again: a join or a filter may
    leave them in a few partitions, and every later pass would use as many tasks.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
