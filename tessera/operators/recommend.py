"""Implicit-feedback recommendation.

Ratings are canonicalised through an alias table with a lookup join (broadcast
only under a checked size).  The popularity baseline is a partial/final sum
per item joined back to the scored pairs.  ALS is ``pyspark.ml``'s blocked
implementation; its input is range-partitioned on (user, item) over a fixed
partition count so a seeded fit is reproducible, and its long lineage is
checkpointed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators.als_many import PackedModel, PackedRatings, pack_ratings
from tessera.operators.evaluate import mean_auc
from tessera.operators.jobs import map_jobs
from tessera.operators.keys import lookup_join
from tessera.session import ensure_checkpoint_dir, stored

#: Numbers about item blocks that may be listed on the driver and shipped to tasks.
MAX_NUMBERS = 16_000_000
#: Blocks whose rows may be dealt among them by direction, and how far their lengths may lie apart.
NEAR, ALIKE = 64, 0.8
#: Bytes of item blocks (by the optimizer's estimate) that may be shipped to every task.
MAX_SHIPPED = 32 * 1024 * 1024


def canonical_ratings(ratings: DataFrame, aliases: DataFrame, item_col: str = "item", aggregate: bool = False) -> DataFrame:
    """Replace an aliased item id by its canonical id (own id when not aliased).

    With ``aggregate`` ratings of one (user, canonical item) are summed (Q8);
    the default keeps every row, as the reference does.
    """
    a = aliases.select(F.col("bad").alias("_bad"), F.col("good").alias("_good"))
    j = lookup_join(ratings, a, (item_col, "_bad"), "left")
    out = j.withColumn(item_col, F.coalesce(F.col("_good"), F.col(item_col))).drop("_bad", "_good")
    if aggregate:
        out = out.groupBy("user", item_col).agg(F.sum("rating").alias("rating"))
    return out


def item_popularity(train: DataFrame, item_col: str = "item", rating_col: str = "rating") -> DataFrame:
    """A5: total rating per item."""
    return train.groupBy(item_col).agg(F.sum(rating_col).alias("popularity"))


def popularity_predictor(train: DataFrame, item_col: str = "item"):
    """A predict function scoring (user, item) by the item's total train rating, 0 if unseen."""
    pop = item_popularity(train, item_col)

    def predict(pairs: DataFrame) -> DataFrame:
        j = lookup_join(pairs, pop, item_col, "left")
        return j.withColumn("score", F.coalesce(F.col("popularity"), F.lit(0.0))).drop("popularity")

    return predict


def top_n_by(df: DataFrame, group: Sequence[str], score_col: str, n: int, tie: Sequence[str], salts: int = 64) -> DataFrame:
    """T4 (generic): first ``n`` rows per group by descending score, ties by ``tie`` ascending.

    Two stages: the top ``n`` of each (group, salt) slice first, so a hot group
    is ranked by ``salts`` tasks, then the top ``n`` of at most ``salts·n``
    survivors per group.  The result is exact: a row in a group's top n is in
    its slice's top n.
    """
    order = [F.col(score_col).desc(), *[F.col(t) for t in tie]]
    salt = F.pmod(F.xxhash64(*[F.col(t) for t in tie]), F.lit(salts))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    first = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return first.drop("_salt", "_r").withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= n)


def fit_als(
    ratings: DataFrame,
    rank: int = 10,
    max_iter: int = 5,
    reg: float = 0.01,
    alpha: float = 1.0,
    seed: int = 0,
    partitions: int | None = None,
    implicit: bool = True,
    packed: PackedRatings | None = None,
) -> ALSModel | PackedModel:
    """L1: implicit ALS (``trainImplicit(ratings, rank, iterations, lambda, alpha)``).

    ``packed`` are the same ratings, packed with this seed for several fits (``als_many``).
    """
    if packed is not None and implicit and max_iter > 0:
        return packed.fit(rank, max_iter, reg, alpha)
    n = partitions or ratings.sparkSession.sparkContext.defaultParallelism
    ensure_checkpoint_dir(ratings.sparkSession)
    # Range partitions on (user, item): content-determined (a seeded fit repeats) and a
    # user with a large share of the ratings spans several partitions.
    data = ratings.select("user", "item", "rating").repartitionByRange(n, "user", "item").sortWithinPartitions("user", "item")
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg,
        alpha=alpha,
        implicitPrefs=implicit,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        seed=seed,
        numUserBlocks=n,
        numItemBlocks=n,
        coldStartStrategy="drop",
        # A checkpoint of the factors (they are small) lets the fit delete the blocks it has shuffled so far.
        checkpointInterval=1,
    )
    return als.fit(data)


def als_predictor(model: ALSModel):
    """Predict function (user, item) → score; unknown users or items yield no row."""

    def predict(pairs: DataFrame) -> DataFrame:
        return model.transform(pairs).withColumnRenamed("prediction", "score").withColumn("score", F.col("score").cast("double"))

    return predict


def factor_text(factors: DataFrame, sep: str = ", ") -> DataFrame:
    """L2: (id, features joined as text)."""
    return factors.select("id", F.array_join(F.transform("features", lambda x: x.cast("string")), sep).alias("text"))


def factor_blocks(factors: DataFrame, size: int) -> DataFrame:
    """(block, ids, vectors, longest, n, low, high): factors packed ``size`` to a row, alike in length and direction.

    Blocks are cut inside range partitions of the falling length, ``NEAR`` blocks at a time, so no
    task orders or holds all of them; ``block`` numbers are unique, ``longest`` is the greatest length in
    a block, ``low`` and ``high`` the least and greatest of each component.
    """
    rows = factors.select("id", F.transform("features", lambda x: x.cast("double")).alias("f"))
    rows = rows.withColumn("length", F.sqrt(X.array_sum(F.transform("f", lambda x: x * x))))
    parts = rows.sparkSession.sparkContext.defaultParallelism
    ordered = rows.repartitionByRange(parts, F.col("length").desc(), "id").sortWithinPartitions(F.col("length").desc(), "id")

    def nearby(v: np.ndarray) -> np.ndarray:
        """An order that puts near vectors together: halved in their widest component until ``size`` are left."""
        out, todo = [], [np.arange(len(v))]
        while todo:
            at = todo.pop()
            if len(at) <= size:
                out.append(at)
                continue
            x = v[at]
            order = np.argsort(x[:, (x.max(axis=0) - x.min(axis=0)).argmax()], kind="stable")
            half = -(-len(at) // size) // 2 * size
            todo += [at[order[half:]], at[order[:half]]]
        return np.concatenate(out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, at = [], TaskContext.get().partitionId() << 32

        def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal at
            table = table.combine_chunks()
            vectors = table.column("f").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(table.num_rows, -1)
            ids, lengths = table.column("id").combine_chunks(), table.column("length").to_numpy()
            order, s = [], 0
            while s < len(lengths):
                alike = int(np.searchsorted(-lengths, -ALIKE * lengths[s], side="right")) - s
                order.append(s + nearby(vectors[s : s + max(size, alike // size * size)]))
                s += len(order[-1])
            order = np.concatenate(order)
            for s in range(0, len(order), size):
                mine = order[s : s + size]
                v = vectors[mine]
                cols = [[at], [ids.take(pa.array(mine)).to_pylist()], [v.tobytes()], [lengths[mine].max()], [len(mine)], [v.min(axis=0)], [v.max(axis=0)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
                at += 1

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= NEAR * size:
                table = pa.Table.from_batches(waiting)
                while table.num_rows >= NEAR * size:
                    yield from packed(table.slice(0, NEAR * size))
                    table = table.slice(NEAR * size)
                waiting = table.to_batches()
        if sum(b.num_rows for b in waiting):
            yield from packed(pa.Table.from_batches(waiting))

    names = ["block", "ids", "vectors", "longest", "n", "low", "high"]
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.float64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    return ordered.mapInArrow(pack, "block long, ids array<int>, vectors binary, longest double, n int, low array<double>, high array<double>")


def _bounds(blocks: list, n: int):
    """``(first, reached)``: which item blocks a block of users meets at first, and which its users' bounds leave.

    A score is bounded by the product of lengths, and by an item block's least and greatest components.
    """
    ids, count, longest, low, high = (np.array([r[c] for r in blocks]) for c in ("block", "n", "longest", "low", "high"))

    def most(u: np.ndarray, at) -> np.ndarray:
        """At most what the users score in the blocks ``at`` (users x blocks), a hair above for rounding."""
        by_length = np.sqrt((u * u).sum(axis=1))[:, None] * longest[at]
        by_box = np.maximum(u, 0) @ high[at].T + np.minimum(u, 0) @ low[at].T
        return np.minimum(by_box, by_length) + 1e-9 * by_length

    def first(u: np.ndarray) -> np.ndarray:
        """Blocks that hold ``n`` items or more together (or all), those first in which the mean user may score most."""
        order = np.argsort(-most(u.mean(axis=0)[None, :], slice(None))[0], kind="stable")
        return ids[order[: int(np.searchsorted(np.cumsum(count[order]), n)) + 1]]

    def reached(u: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Blocks in which one of the users may score ``least`` (one number per user) or more."""
        lowest, highest = u.min(axis=0), u.max(axis=0)
        ends = np.maximum(np.maximum(lowest * low, lowest * high), np.maximum(highest * low, highest * high)).sum(axis=1)
        by_length = np.sqrt((u * u).sum(axis=1).max()) * longest
        some = np.flatnonzero(~(np.minimum(ends, by_length) + 1e-9 * by_length < least.min()))
        step = max(1, 4_000_000 // len(u))
        hit = [(~(most(u, some[s : s + step]) < least[:, None])).any(axis=0) for s in range(0, len(some), step)]
        return ids[some[np.concatenate(hit)] if hit else some]

    return first, reached


def _best_of_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """(user_block, user, item, score): the top ``n`` of each user in each block of items it is paired with.

    Scores below a user's entry in ``least``, if there is one, may be left out.
    """
    side = items.select("block", F.col("ids").alias("i_ids"), F.col("vectors").alias("i_vectors"), F.col("n").alias("i_n"))
    who = users.select(F.col("block").alias("user_block"), "ids", "vectors", "n", "least")
    met = lookup_join(pairs, side, "block", "inner", MAX_SHIPPED).join(who, "user_block")
    met = met.select("user_block", "ids", "vectors", "n", "least", "i_ids", "i_vectors", "i_n")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                u = np.frombuffer(r["vectors"], dtype="<f8").reshape(r["n"], -1)
                v = np.frombuffer(r["i_vectors"], dtype="<f8").reshape(r["i_n"], -1)
                names, scores = np.array(r["i_ids"]), u @ v.T
                top = np.full(len(u), -np.inf) if len(v) <= n else np.partition(scores, -n, axis=1)[:, -n]
                if r["least"] is not None:
                    top = np.maximum(top, np.frombuffer(r["least"], dtype="<f8"))
                # A matrix product rounds by no more than a tiny share of the product of lengths.
                hair = 1e-12 * (1 + np.sqrt((u * u).sum(axis=1) * (v * v).sum(axis=1).max()))
                i, j = np.nonzero(scores >= (top - hair)[:, None])
                # Components in order, so a pair's score does not depend on its blocks.
                exact = np.zeros(len(i))
                for c in range(u.shape[1]):
                    exact += u[i, c] * v[j, c]
                order = np.lexsort((names[j], -exact, i))
                i, j, exact = i[order], j[order], exact[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < n
                i, j, exact = i[keep], j[keep], exact[keep]
                block = np.full(len(i), r["user_block"], dtype=np.int64)
                cols = [pa.array(block), pa.array(np.array(r["ids"], dtype=np.int32)[i]), pa.array(names[j].astype(np.int32)), pa.array(exact)]
                yield pa.RecordBatch.from_arrays(cols, names=["user_block", "user", "item", "score"])

    return met.mapInArrow(score, "user_block long, user int, item int, score double")


def recommend(model: ALSModel, users: DataFrame, n: int = 5, block: int = 4096) -> DataFrame:
    """L3/T4: top ``n`` items for each given user → (user, item, score, rank); ties go to the smaller item id.

    Users and items are packed into blocks of like length and direction, and block
    pairs are joined on block ids and scored by one matrix product each:

    1. every user block meets a few item blocks that hold ``n`` items or more, which
       gives each user a lower bound for its n-th best score;
    2. a score is at most the product of the lengths, and at most what the least and
       greatest components of an item block allow.  So a user block then needs only
       the item blocks in which one of its users may reach its bound.

    Of the items, lengths and ends of the components of each block reach the driver
    (``2 * rank + 1`` numbers per ``block`` items).

    Users without factors get no row, an empty model none at all.
    """
    return recommend_from(model.userFactors, model.itemFactors, users, n, block)


def recommend_from(user_factors: DataFrame, item_factors: DataFrame, users: DataFrame, n: int = 5, block: int = 4096) -> DataFrame:
    """``recommend`` for given factor tables (id, features)."""
    wanted = user_factors.join(users.select(F.col("user").alias("id")).distinct(), "id", "left_semi")
    u = stored(factor_blocks(wanted, block), "user-blocks")
    i = stored(factor_blocks(item_factors, block), "item-blocks")
    size = i.agg(F.count(F.lit(1)).alias("blocks"), F.max(F.size("low")).alias("width")).first()
    if not size["blocks"]:
        return u.sparkSession.createDataFrame([], "user int, item int, score double, rank int")
    if size["blocks"] * (2 * size["width"] + 1) > MAX_NUMBERS:
        raise ValueError("too many item blocks: raise the block size")
    first, reached = _bounds(i.select("block", "n", "longest", "low", "high").orderBy("block").collect(), n)
    order = Window.partitionBy("user_block", "user").orderBy(F.col("score").desc(), "item")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                met = first(np.frombuffer(r["vectors"], dtype="<f8").reshape(r["n"], -1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), r["block"], dtype=np.int64)), pa.array(met)], names=["user_block", "block"])

    pairs = stored(u.select("block", "vectors", "n").mapInArrow(start, "user_block long, block long"), "first-pairs")
    one = stored(ranked(_best_of_pairs(pairs, u.withColumn("least", F.lit(None).cast("binary")), i, n)), "first")
    kth = one.groupBy("user_block", "user").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("s"))
    # One short list per user block; a user with fewer than ``n`` items so far has no bound.
    known = kth.filter(F.col("m") >= n).groupBy(F.col("user_block").alias("block")).agg(F.collect_list("user").alias("users"), F.collect_list("s").alias("s"))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                v = np.frombuffer(r["vectors"], dtype="<f8").reshape(r["n"], -1)
                bound = dict(zip(r["users"] or [], r["s"] or [], strict=True))
                least = np.array([bound.get(who, -np.inf) for who in r["ids"]])
                meets = np.setdiff1d(reached(v, least), first(v))
                cols = [[r["block"]], [r["ids"]], [r["vectors"]], [r["n"]], [least.astype("<f8").tobytes()], [meets]]
                kinds = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["block", "ids", "vectors", "n", "least", "meets"])

    bounded = u.join(known, "block", "left").select("block", "ids", "vectors", "n", "users", "s")
    bounded = stored(bounded.mapInArrow(passed, "block long, ids array<int>, vectors binary, n int, least binary, meets array<long>"), "bounded")
    rest = bounded.select(F.col("block").alias("user_block"), F.explode("meets").alias("block"))
    both = one.drop("rank").unionByName(_best_of_pairs(rest, bounded, i, n))
    return ranked(both).select("user", "item", "score", "rank")


def recommendation_lines(recs: DataFrame) -> DataFrame:
    """``user -> item, item, ...`` in rank order (``mkString``)."""
    g = recs.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("r"))
    return g.select("user", F.concat(F.col("user").cast("string"), F.lit(" -> "), F.array_join(F.transform("r", lambda s: s["item"].cast("string")), ", ")).alias("line"))


def als_grid(
    train: DataFrame,
    positives: DataFrame,
    negatives: DataFrame,
    ranks: Sequence[int] = (10, 50),
    regs: Sequence[float] = (1.0, 0.0001),
    alphas: Sequence[float] = (1.0, 40.0),
    max_iter: int = 10,
    seed: int = 0,
    parallel: int = 1,
) -> DataFrame:
    """Mean AUC of every (rank, lambda, alpha), best first.  Inputs are cached across fits;
    ``parallel`` > 1 fits that many parameter sets at once (concurrent jobs).  Many ratings are
    packed once for all fits (``als_many``)."""
    spark = train.sparkSession
    train = train.select("user", "item", "rating").persist()
    positives = positives.persist()
    negatives = negatives.persist()

    def start(users: DataFrame, rank: int) -> DataFrame:
        return fit_als(users, rank, 0, seed=seed).userFactors

    def one(params):
        rank, reg, alpha = params
        model = fit_als(train, rank, max_iter, reg, alpha, seed, packed=packed)
        auc = mean_auc(positives, negatives, als_predictor(model)).first()["mean_auc"]
        return (int(rank), float(reg), float(alpha), float(auc) if auc is not None else None)

    try:
        # About a task for each core in all the passes that run at once: every task sends its own sums of the items.
        tasks = -(-spark.sparkContext.defaultParallelism // max(1, min(parallel, len(ranks) * len(regs) * len(alphas))))
        packed = pack_ratings(train, ranks, start, tasks)
        rows = map_jobs(one, product(ranks, regs, alphas), parallel)
    finally:
        train.unpersist()
        positives.unpersist()
        negatives.unpersist()
    df = spark.createDataFrame(rows, "rank int, lambda double, alpha double, auc double")
    return df.orderBy(F.col("auc").desc_nulls_last(), "rank", "lambda", "alpha")
