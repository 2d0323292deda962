"""Nearest vectors by inner product from an inverted multi-index.

* **Index**: both halves of a vector are quantised separately, with ``centroids(rows)``
  centroids each, fitted on a sample of about ``SAMPLE`` rows (by hash of the row; the
  bound is the parameter).  Every row is indexed under its centroid pair, its cell.
  Cells are laid out in blocks of about ``BLOCK`` rows, neighbouring cells together; a
  cell with more rows is dealt over several blocks.
* **Traversal**: the distance of a query and a cell is minus their inner product, which is
  the sum of the two halves' distances.  Each half's centroids are sorted by it, and a
  heap yields the cells in ascending order of the sum.
* **Two rounds**: the first goes on until the cells passed hold ``FIRST`` rows; their
  exact inner products give a lower bound t for the query's k-th best.  The second starts
  anew and goes on as long as a cell may hold better rows: with q * (x - c) spread as
  ``|q| * sigma``, cells are passed while ``q * c >= t - z |q| sigma``.  z is the normal
  quantile at which all rows in cells left out are expected to hold at most
  ``MISSED * k`` better ones together, whatever their number.  Close neighbours end a
  search early, far ones make it long; a query with fewer than k rows found sees all.
* **Reranking**: queries, blocked like the rows, meet the blocks they pass, each pair in
  one task step; rows of passed cells get their exact inner products (double, components
  in order), and only the k best of a pair go on.

The driver gets the sample, the centroids and one count per non-empty cell (at most
``MOST`` squared).  Tasks hold those and one block of either kind.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no
part; of several rows with a query's id the least vector asks, and none of them is a
candidate; repeated candidate rows each have their place; a null id never asks and comes
after the others on ties; fewer candidates than k are all returned; an empty table gives
an empty result; vectors of different widths or of odd width one raise ValueError.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import held, quoted, read_table

K, EVERY = 20, 20
SAMPLE = 8192
PER_CELL, FEWEST, MOST = 48, 4, 1024
BLOCK, QUERY_BLOCK = 2048, 512
FIRST = 1500
MISSED = 0.5
ROUNDS = 10


def centroids(rows: int) -> int:
    """Centroids per half: about PER_CELL rows a cell, a power of two, at most MOST."""
    return min(MOST, max(FEWEST, 1 << max(0, round(math.log2(max(1.0, rows / PER_CELL)) / 2))))


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """Non-null vectors of one width as float64 rows."""
    sizes = np.diff(vectors.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors must have one width")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def fit(points: np.ndarray, k: int) -> np.ndarray:
    """k-means on the sample; the first centroids are spread over the rows as given."""
    book = points[np.linspace(0, len(points) - 1, k).astype(np.int64)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, book)
        n = np.bincount(own, minlength=k)
        for j in np.flatnonzero(n):
            book[j] = points[own == j].mean(axis=0)
    return book


def nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1) - 2 * points @ book.T).argmin(axis=1)


class Index:
    """What a task needs to know: both codebooks, rows per cell, and the blocks of a cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray, sigma: float):
        self.books, self.k, self.cut, self.sigma = (first, second), len(first), first.shape[1], sigma
        self.counts = self.start = self.split = None

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, : self.cut], self.books[0]) * self.k + nearest(x[:, self.cut :], self.books[1])

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query, the distance of its halves to the centroids of each half."""
        return -(x[:, : self.cut] @ self.books[0].T), -(x[:, self.cut :] @ self.books[1].T)

    def traverse(self, d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[float, int]]:
        """(distance, cell) in ascending order of distance, by a heap over pairs of ranks."""
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        o1, o2, k = o1.tolist(), o2.tolist(), self.k
        heap = [(s1[0] + s2[0], 0, 0)]
        while heap:
            d, i, j = heappop(heap)
            yield d, o1[i] * k + o2[j]
            if j + 1 < k:
                heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
            if j == 0 and i + 1 < k:
                heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))


def layout(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of every cell, and over how many blocks its rows are dealt; small neighbours share a block."""
    start, split = np.zeros(len(counts), np.int32), np.ones(len(counts), np.int32)
    block, fill = 0, 0
    for cell in np.flatnonzero(counts).tolist():
        n = int(counts[cell])
        if fill and fill + n > size:
            block, fill = block + 1, 0
        start[cell] = block
        if n > size:
            split[cell] = -(-n // size)
            block += int(split[cell])
        else:
            fill += n
    return start, split


def sound(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` of the rows that take part."""
    rows = df.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("vector") > 0) & fine & F.exists("vector", lambda x: x != 0))


def build(rows: DataFrame, sample: int) -> tuple[DataFrame, Index | None]:
    """Fit on a sample, then write every row with its cell."""
    total = rows.agg(F.count(F.lit(1))).first()[0]
    share = min(1.0, sample / max(1, total))
    hashed = rows.withColumn("h", F.xxhash64("id", "vector"))
    picked = hashed.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(2 * sample).toArrow().sort_by("h")
    if not picked.num_rows:
        picked = hashed.limit(sample).toArrow().sort_by("h")
    if not picked.num_rows:
        return rows.withColumn("cell", F.lit(0)), None
    x = as_matrix(picked.column("vector").combine_chunks())
    if x.shape[1] < 2:
        raise ValueError("vectors need two components to be halved")
    cut, k = x.shape[1] // 2, centroids(total)
    books = [fit(x[:, :cut], k), fit(x[:, cut:], k)]
    off = sum(((half - book[nearest(half, book)]) ** 2).sum(axis=1) for half, book in zip((x[:, :cut], x[:, cut:]), books, strict=True))
    index = Index(*books, float(np.sqrt(np.quantile(off, 0.9) / x.shape[1])))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = index.cells(as_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.int32())], names=["id", "vector", "cell"])

    return held(rows.mapInArrow(code, "id long, vector array<double>, cell int"), "cells"), index


def cell_counts(coded: DataFrame, cells: int) -> np.ndarray:
    out = np.zeros(cells, dtype=np.int64)
    for cell, n in coded.groupBy("cell").count().collect():
        out[cell] = n
    return out


def blocked(coded: DataFrame, start: np.ndarray, split: np.ndarray) -> DataFrame:
    """One row per block: ``block``, ids and cells as lists, vectors as float64 bytes, by cell."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()  # rows of a large cell are dealt in turn
        for batch in batches:
            cell = batch.column(2).to_numpy()
            block = start[cell] + (turn + np.arange(len(cell))) % split[cell]
            turn += len(cell)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block, pa.int32())], names=["id", "vector", "cell", "block"])

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("id", "ascending")]).combine_chunks()
        x = as_matrix(table.column("vector").combine_chunks())
        n = table.num_rows
        return pa.table(
            {
                "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
                "cells": pa.array([table.column("cell").to_numpy().astype("<i4").tobytes()], pa.binary()),
                "vectors": pa.array([x.astype("<f8").tobytes()], pa.binary()),
                "n": pa.array([n], pa.int32()),
            }
        )

    dealt = coded.mapInArrow(place, "id long, vector array<double>, cell int, block int")
    return dealt.groupBy("block").applyInArrow(gather, "block int, ids array<long>, cells binary, vectors binary, n int")


def matrix(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<f8").reshape(n, -1)


def probe(queries: DataFrame, index: Index, first: int, reach: float | None) -> DataFrame:
    """Query blocks with, per query, how far its traversal goes (``limits``, ``floors``), and the row blocks it passes.

    With ``reach`` None a traversal ends once ``first`` rows are passed.  Else ``best``
    holds (query_id, k-th best so far or null), and it ends where a cell lies ``reach``
    times the query's length short of that, but not before ``first`` rows either.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, start, split = index.counts, index.start, index.split
        for batch in batches:
            for row in batch.to_pylist():
                x = matrix(row["vectors"], row["n"])
                known = {b["query_id"]: b["kth"] for b in row.get("best") or ()}
                d1, d2 = index.distances(x)
                size = np.sqrt((x * x).sum(axis=1))
                limits, floors, passed = np.empty(len(x)), np.full(len(x), -np.inf), set()
                for i, qid in enumerate(row["ids"]):
                    bound = -np.inf
                    if reach is not None:
                        kth = known.get(qid)
                        bound = np.inf if kth is None else reach * size[i] - kth
                        floors[i] = -np.inf if kth is None else kth
                    seen, last = 0, 0.0
                    for d, cell in index.traverse(d1[i], d2[i]):
                        if seen >= first and d > bound:
                            break
                        last = d
                        if counts[cell]:
                            seen += int(counts[cell])
                            passed.add(cell)
                    limits[i] = last
                cells = np.fromiter(passed, dtype=np.int64, count=len(passed))
                blocks = sorted({b for c in cells.tolist() for b in range(int(start[c]), int(start[c] + split[c]))})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int32()),
                        pa.array([row["ids"]], pa.list_(pa.int64())),
                        pa.array([row["vectors"]], pa.binary()),
                        pa.array([limits.astype("<f8").tobytes()], pa.binary()),
                        pa.array([floors.astype("<f8").tobytes()], pa.binary()),
                        pa.array([blocks], pa.list_(pa.int32())),
                        pa.array([len(x)], pa.int32()),
                    ],
                    names=["query_block", "ids", "vectors", "limits", "floors", "blocks", "n"],
                )

    return queries.mapInArrow(walk, "query_block int, ids array<long>, vectors binary, limits binary, floors binary, blocks array<int>, n int")


def best_of_pair(index: Index, k: int, q: np.ndarray, qid: np.ndarray, limit: np.ndarray, floor: np.ndarray, e: np.ndarray, eid: pa.Array, cell: np.ndarray):
    """(query, row, score) of the k best rows in passed cells for every query of one block against one block of rows."""
    d1, d2 = index.distances(q)
    kinds, own = np.unique(cell, return_inverse=True)
    slack = 1e-9 * (1 + np.abs(limit))
    passed = d1[:, kinds // index.k] + d2[:, kinds % index.k] <= (limit + slack)[:, None]
    rows = np.flatnonzero(passed.any(axis=1))
    cols = np.flatnonzero(passed.any(axis=0)[own])
    ids = eid.to_numpy(zero_copy_only=False) if not eid.null_count else pc.fill_null(eid, 0).to_numpy()
    void = eid.is_null().to_numpy(zero_copy_only=False)
    score = q[rows] @ e[cols].T
    out = ~passed[np.ix_(rows, own[cols])] | ((qid[rows][:, None] == ids[cols][None]) & ~void[cols][None])
    score[out] = -np.inf
    least = floor[rows]
    if len(cols) > k:
        least = np.maximum(least, np.partition(score, -k, axis=1)[:, -k])
    # The product above may round otherwise than the exact one below: keep what is as good but for rounding.
    near = 1e-9 * (1e-300 + np.abs(q[rows]).max(axis=1, initial=0) * np.abs(e[cols]).max(initial=0) * q.shape[1])
    i, j = np.nonzero((score >= (least - near)[:, None]) & ~out)
    i, j = rows[i], cols[j]
    exact = np.zeros(len(i))
    for at in range(q.shape[1]):
        exact += q[i, at] * e[j, at]
    order = np.lexsort((ids[j], void[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    first = np.searchsorted(i, i, side="left")
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep], exact[keep]


def rerank(probes: DataFrame, blocks: DataFrame, index: Index, k: int) -> DataFrame:
    """``query_block, query_id, rank, vec_id, score``: the k best rows of the cells each query passes."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(c)[r] for c, name in enumerate(batch.schema.names)}
                q, e = matrix(row["vectors"].as_py(), row["n"].as_py()), matrix(row["e_vectors"].as_py(), row["e_n"].as_py())
                qid, eid = row["ids"].values.to_numpy(), row["e_ids"].values
                limit, floor = (np.frombuffer(row[c].as_py(), dtype="<f8") for c in ("limits", "floors"))
                i, j, exact = best_of_pair(index, k, q, qid, limit, floor, e, eid, np.frombuffer(row["cells"].as_py(), dtype="<i4"))
                block = np.full(len(i), row["query_block"].as_py(), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(qid[i]), eid.take(pa.array(j)), pa.array(exact)], names=["query_block", "query_id", "vec_id", "score"]
                )

    pairs = probes.select("query_block", F.explode("blocks").alias("block"))
    side = blocks.select("block", F.col("ids").alias("e_ids"), "cells", F.col("vectors").alias("e_vectors"), F.col("n").alias("e_n"))
    met = pairs.join(side, "block").join(probes.drop("blocks"), "query_block")
    found = met.mapInArrow(score, "query_block int, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_block", "query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_vectors(
    df: DataFrame, wanted: DataFrame | None = None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, missed: float = MISSED, first: int = FIRST, sample: int = SAMPLE
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every id of ``wanted`` (a column ``id``; null: all) its k nearest other rows found."""
    rows = sound(df, id_col, vector_col)
    coded, index = build(rows, sample)
    if index is None:
        return coded.where(F.lit(False)).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    index.counts = cell_counts(coded, index.k**2)
    index.start, index.split = layout(index.counts, BLOCK)
    blocks = held(blocked(coded, index.start, index.split), "blocks")
    asking = coded.where("id IS NOT NULL")
    if wanted is not None:
        asking = asking.join(wanted.select(F.col("id").cast("long")).distinct(), "id", "left_semi")
    asking = held(asking.groupBy("id").agg(F.min(F.struct("vector", "cell")).alias("m")).select("id", "m.vector", "m.cell"), "queries")
    queries = held(blocked(asking, *layout(cell_counts(asking, index.k**2), QUERY_BLOCK)), "query-blocks")
    once = rerank(held(probe(queries, index, first, None), "probes"), blocks, index, k)
    kth = once.groupBy("query_block", "query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    best = kth.groupBy("query_block").agg(F.collect_list(F.struct("query_id", "kth")).alias("best"))
    known = queries.join(best.withColumnRenamed("query_block", "block"), "block", "left")
    total = max(2, int(index.counts.sum()))
    # With nothing to be missed every cell is passed.
    reach = -NormalDist().inv_cdf(min(0.5, missed * k / total)) * index.sigma if missed > 0 else math.inf
    probes = held(probe(known, index, first, reach), "probes")
    return rerank(probes, blocks, index, k).select("query_id", "rank", "vec_id", "score")


def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    wanted = table.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").alias("id"))
    return nearest_vectors(table, wanted)
