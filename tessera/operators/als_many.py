"""Implicit ALS over many ratings of not too many items: users are solved where their ratings lie.

``pyspark.ml`` sends the factors of each side to all blocks of the other side in every half step and adds
one rating at a time.  Here a user's ratings are packed once, in rows of many whole users.  An iteration is
one pass over these rows: a task solves its users from the item factors, which are shipped whole (their
bytes are checked first), and adds up the normal equations of the items by matrix products.  Sums of items
with many ratings are kept per task, at most ``MAX_SUMS`` bytes; ratings of the others are sent on with
their user's factors.  One shuffle by blocks of items brings both together, where the items are solved.

First factors, weights, regularisation, the order of half steps and the rounding of factors to floats are
those of ``pyspark.ml`` with the same seed and number of blocks; sums are taken in another order.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import stored

#: Ratings from which on a grid's fits read packed ratings.
MANY_RATINGS = 100_000
#: Ratings in a packed row (about; whole users only).
ROW_RATINGS = 1 << 19
#: Bytes of item factors that may be shipped to every task, of the item sums a task keeps, and of rows gathered at once.
MAX_SHIPPED, MAX_SUMS, GATHERED = 32 << 20, 112 << 20, 4 << 20
#: Items that are solved together.
ITEM_BLOCK = 256


def normal(factors: np.ndarray, idx: np.ndarray, weight: np.ndarray, target: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(segments, A, b): sums of ``weight * x x'`` and ``target * x`` over every segment that has members, alike in length together.

    Segment ``s`` has the members ``starts[s]`` to ``starts[s] + counts[s]``, whose ``x`` are ``factors[idx[member]]``.
    """
    k = factors.shape[1]
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 0]
    most = max(1, GATHERED // (8 * k))  # members gathered at once
    at = 0
    while at < len(order):
        some = order[at : at + max(1, most // counts[order[at]])]
        some = some[: max(1, most // counts[some[-1]])]
        at += len(some)
        first, n = starts[some][:, None], counts[some][:, None]
        a, b = 0.0, 0.0
        for lo in range(0, int(n[-1, 0]), most):
            step = np.arange(lo, min(lo + most, int(n[-1, 0])))
            inside = step < n
            members = np.where(inside, first + step, first)
            x = factors[idx[members]]
            a = a + np.matmul(x.transpose(0, 2, 1), x * (weight[members] * inside)[:, :, None])
            b = b + np.matmul((target[members] * inside)[:, None, :], x)[:, 0]
        yield some, a, b


def solved(a: np.ndarray, b: np.ndarray, gram: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Factors, as floats, of the normal equations ``(gram + a + ridge I) x = b``; ``a`` is changed."""
    a += gram
    d = np.arange(a.shape[1])
    a[:, d, d] += ridge[:, None]
    return np.linalg.solve(a, b[:, :, None])[:, :, 0].astype(np.float32)


def weights(r: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Confidence less one and target of ratings: ``alpha |r|``, and one more where the rating is positive, else 0."""
    w = alpha * np.abs(r.astype(np.float64))
    return w, np.where(r > 0, 1.0 + w, 0.0)


class PackedRatings:
    """Ratings in rows of whole users (users, counts, items by number, ratings, their order by item, first factors)."""

    def __init__(self, rows: DataFrame, ids: np.ndarray, n: np.ndarray, positive: np.ndarray, offsets: Mapping[int, int], tasks: int):
        self.rows, self.ids, self.n, self.positive, self.offsets, self.tasks = rows, ids, n, positive, offsets, tasks

    def _pass(self, rank: int, items: np.ndarray | None, reg: float, alpha: float, sums: bool) -> DataFrame:
        """One pass over the rows: users solved from ``items`` (or their first factors), then what the items' equations need, or the users."""
        offset, width, total = self.offsets[rank], sum(self.offsets), len(self.ids)
        upper = np.triu_indices(rank)
        size = len(upper[0])
        enough = int(np.searchsorted(-self.n, -self.tasks * rank, side="right"))  # items are numbered by falling ratings
        kept = min(enough, MAX_SUMS // (8 * (size + rank)))
        shipped = None if items is None else self.rows.sparkSession.sparkContext.broadcast(items)

        def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
            kinds = ["<i4", "<i4", "<i4", "<f4", "<i4", "<f4"]
            for batch in batches:
                for i in range(batch.num_rows):
                    yield [np.frombuffer(c[i].as_buffer(), dtype=t) for c, t in zip(batch.columns, kinds, strict=False)]

        def users_of(y: np.ndarray | None, gram: np.ndarray | None, row: list[np.ndarray]) -> np.ndarray:
            users, counts, number, r = row[:4]
            if y is None:
                return row[5].reshape(len(users), width)[:, offset : offset + rank]
            w, t = weights(r, alpha)
            starts = np.cumsum(counts, dtype=np.int64) - counts
            ridge = reg * np.add.reduceat(r > 0, starts, dtype=np.int64)
            x = np.empty((len(users), rank), dtype=np.float32)
            for some, a, b in normal(y, number, w, t, starts, counts):
                x[some] = solved(a, b, gram, ridge[some])
            return x

        def begin() -> tuple[np.ndarray | None, np.ndarray | None]:
            y = None if shipped is None else shipped.value.astype(np.float64)
            return y, None if y is None else y.T @ y

        def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            y, gram = begin()
            for row in arrays(batches):
                x = users_of(y, gram, row)
                ends = np.arange(0, x.size + 1, rank, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(row[0]), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], names=["id", "features"])

        names = ["block", "task", "part", "sums", "gram", "number", "r", "x"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

        def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            y, gram = begin()
            task, part = TaskContext.get().partitionId(), 0
            held = np.zeros((kept, size + rank))
            own = np.zeros((rank, rank))
            for row in arrays(batches):
                part += 1
                x = users_of(y, gram, row)
                x8 = x.astype(np.float64)
                own += x8.T @ x8
                _, counts, number, r, order = row[:5]
                who, r = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[order], r[order]
                w, t = weights(r, alpha)
                n = np.bincount(number, minlength=total)
                starts = np.cumsum(n) - n
                for some, a, b in normal(x8, who, w, t, starts[:kept], n[:kept]):
                    held[some, :size] += a[:, upper[0], upper[1]]
                    held[some, size:] += b
                lo = int(n[:kept].sum())
                if lo < len(order):
                    rest = number[order[lo:]]
                    cuts = [0, *(np.flatnonzero(np.diff(rest // ITEM_BLOCK)) + 1).tolist(), len(rest)]
                    pieces = [(int(rest[i]) // ITEM_BLOCK, task, part, None, None, rest[i:j].tobytes(), r[lo + i : lo + j].tobytes(), x[who[lo + i : lo + j]].tobytes()) for i, j in zip(cuts, cuts[1:], strict=False)]
                    yield batch_of(pieces)
            for lo in range(0, total, ITEM_BLOCK) if part else ():
                mine = held[lo : lo + ITEM_BLOCK]
                yield batch_of([(lo // ITEM_BLOCK, task, 0, mine.tobytes() if len(mine) else None, own.tobytes(), None, None, None)])

        positive = self.positive

        def items_of(table: pa.Table) -> pa.Table:
            block = table.column("block")[0].as_py()
            lo = block * ITEM_BLOCK
            n = min(ITEM_BLOCK, total - lo)
            a, b, own = np.zeros((n, rank, rank)), np.zeros((n, rank)), np.zeros((rank, rank))
            held = np.zeros((n, size + rank))
            sent: list[list[np.ndarray]] = []
            read = lambda c, i, t: np.frombuffer(table.column(c)[i].as_buffer(), dtype=t)
            for i in np.lexsort((table.column("part").to_numpy(), table.column("task").to_numpy())).tolist():
                if table.column("gram")[i].is_valid:
                    own += read("gram", i, "<f8").reshape(rank, rank)
                if table.column("sums")[i].is_valid:
                    s = read("sums", i, "<f8").reshape(-1, size + rank)
                    held[: len(s)] += s
                if table.column("x")[i].is_valid:
                    sent.append([read("number", i, "<i4") - lo, read("r", i, "<f4"), read("x", i, "<f4").reshape(-1, rank)])
            a[:, upper[0], upper[1]] = held[:, :size]
            a[:, upper[1], upper[0]] = held[:, :size]
            b += held[:, size:]
            if sent:
                number, r, x = (np.concatenate(c) for c in zip(*sent, strict=True))
                order = np.argsort(number, kind="stable")
                counts = np.bincount(number, minlength=n)
                w, t = weights(r[order], alpha)
                for some, more, target in normal(x.astype(np.float64), order, w, t, np.cumsum(counts) - counts, counts):
                    a[some] += more
                    b[some] += target
            y = solved(a, b, own, reg * positive[lo : lo + n])
            return pa.table({"block": pa.array([block], pa.int32()), "y": pa.array([y.tobytes()], pa.binary())})

        read = self.rows.select("users", "counts", "items", "ratings", "by_item", *(["start"] if items is None else [])).coalesce(self.tasks)
        if not sums:
            return read.mapInArrow(factors, "id int, features array<float>")
        sent = read.mapInArrow(equations, "block int, task int, part int, sums binary, gram binary, number binary, r binary, x binary")
        return sent.groupBy("block").applyInArrow(items_of, "block int, y binary")

    def fit(self, rank: int, max_iter: int, reg: float, alpha: float) -> PackedModel:
        items = None
        for _ in range(max_iter):
            found = self._pass(rank, items, reg, alpha, sums=True).collect()
            items = np.empty((len(self.ids), rank), dtype=np.float32)
            for r in found:
                items[r["block"] * ITEM_BLOCK : (r["block"] + 1) * ITEM_BLOCK] = np.frombuffer(r["y"], dtype="<f4").reshape(-1, rank)
            # The shuffle of the pass is not read again: its files go when nothing here or in the driver's JVM names it.
            gc.collect()
            self.rows.sparkSession.sparkContext._jvm.java.lang.System.gc()
        return PackedModel(self._pass(rank, items, reg, alpha, sums=False), self.ids, items)


class PackedModel:
    """What grids read of an ``ALSModel``: ``userFactors``, ``itemFactors`` and ``transform``, which drops unknown users and items."""

    def __init__(self, users: DataFrame, ids: np.ndarray, items: np.ndarray):
        self.userFactors, self._ids, self._items = users, ids, items

    @property
    def itemFactors(self) -> DataFrame:
        rows = [(int(i), x.tolist()) for i, x in zip(self._ids, self._items, strict=True)]
        return self.userFactors.sparkSession.createDataFrame(rows, "id int, features array<float>")

    def transform(self, pairs: DataFrame) -> DataFrame:
        by_id = np.argsort(self._ids)
        shipped = pairs.sparkSession.sparkContext.broadcast((self._ids[by_id], self._items[by_id]))
        rank, names = self._items.shape[1], pairs.columns

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, items = shipped.value
            for batch in batches:
                item = batch.column(names.index("item"))
                batch = batch.filter(pc.is_valid(item))
                item = batch.column(names.index("item")).to_numpy()
                at = np.minimum(np.searchsorted(ids, item), len(ids) - 1)
                x = batch.column(len(names)).flatten().to_numpy().reshape(-1, rank)
                score = (x.astype(np.float64) * items[at]).sum(axis=1).astype(np.float32)
                out = pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(score)], names=[*names, "prediction"])
                yield out.filter(pa.array(ids[at] == item))

        met = pairs.join(self.userFactors.select(F.col("id").alias("_id"), F.col("features").alias("_x")), F.col("user") == F.col("_id")).drop("_id")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
        return met.mapInArrow(score, f"{kinds}, prediction float")


def pack_ratings(train: DataFrame, ranks: Sequence[int], start, tasks: int) -> PackedRatings | None:
    """(user, item, rating) rows packed for fits of these ranks; None where they are few, their items many, or a value is missing.

    ``start`` gives the first user factors of a rank from a frame of one rating per user.
    """
    kinds = dict(train.dtypes)
    if kinds["user"] != "int" or kinds["item"] != "int" or not ranks:
        return None
    r = F.col("rating").cast("float")
    missing = F.col("user").isNull() | F.col("item").isNull() | r.isNull() | F.isnan(r) | (F.abs(r) == float("inf"))
    most = MAX_SHIPPED // (4 * max(ranks))
    per_item = train.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum((r > 0).cast("long")).alias("positive"), F.max(missing).alias("missing"))
    found = per_item.limit(most + 1).toArrow()
    if found.num_rows > most or pc.any(found.column("missing")).as_py() or (pc.sum(found.column("n")).as_py() or 0) <= MANY_RATINGS:
        return None
    ids, n, positive = (found.column(c).to_numpy() for c in ("item", "n", "positive"))
    order = np.lexsort((ids, -n))
    ids, n, positive = ids[order], n[order], positive[order]
    by_id = np.argsort(ids)
    known = ids[by_id]

    users = stored(train.select("user").distinct(), "rated")
    one = users.select("user", F.col("user").alias("item"), F.lit(1.0).alias("rating"))
    ranks = sorted(set(ranks))
    offsets = dict(zip(ranks, np.cumsum([0, *ranks[:-1]]).tolist(), strict=True))
    firsts = [start(one, k).select(F.col("id").alias("user"), F.col("features").alias(f"x{k}")) for k in ranks]
    first = reduce(lambda a, b: a.join(b, "user"), firsts).select("user", F.concat(*[f"x{k}" for k in ranks]).alias("start"))

    def packed(u: np.ndarray, item: np.ndarray, rating: np.ndarray, is_first: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(is_first)
        counts = np.diff([*at, len(u)]) - 1
        number = by_id[np.searchsorted(known, item[~is_first])].astype("<i4")
        cols = [u[at].astype("<i4"), counts.astype("<i4"), number, rating[~is_first].astype("<f4"), np.argsort(number, kind="stable").astype("<i4"), x.astype("<f4")]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], names=["users", "counts", "items", "ratings", "by_item", "start"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            user, item, rating, x = batch.columns
            held.append([user.to_numpy(), pc.fill_null(item, 0).to_numpy(), pc.fill_null(rating, 0).to_numpy(), item.is_null().to_numpy(zero_copy_only=False), x.flatten().to_numpy()])
            rows += batch.num_rows
            if rows >= 2 * ROW_RATINGS:
                u, i, v, f, x = (np.concatenate(c) for c in zip(*held, strict=True))
                cut = int(np.searchsorted(u, u[-1]))  # the last user may go on
                wide = len(x) // max(1, int(f.sum())) * int(f[:cut].sum())
                if cut:
                    yield packed(u[:cut], i[:cut], v[:cut], f[:cut], x[:wide])
                held, rows = [[u[cut:], i[cut:], v[cut:], f[cut:], x[wide:]]], len(u) - cut
        if rows:
            yield packed(*(np.concatenate(c) for c in zip(*held, strict=True)))

    parts = max(train.sparkSession.sparkContext.defaultParallelism, -(-int(n.sum()) // ROW_RATINGS))
    rated = train.select("user", "item", r.alias("rating"), F.lit(None).cast("array<float>").alias("start"))
    both = rated.unionByName(first.select("user", F.lit(None).cast("int").alias("item"), F.lit(None).cast("float").alias("rating"), "start"))
    dealt = both.repartition(parts, "user").sortWithinPartitions("user", F.col("item").asc_nulls_first(), "rating")
    rows = stored(dealt.mapInArrow(pack, ", ".join(f"{c} binary" for c in ("users", "counts", "items", "ratings", "by_item", "start"))), "packed-ratings")
    return PackedRatings(rows, ids, n, positive, offsets, tasks)
