"""Vector codes by product quantisation: Lloyd rounds driven by two trees.

A vector's components become integers, ``floor(scale * x)``, and are cut into ``parts``
equal consecutive parts.  Every part position has its own codebook, which starts as
that part of the vectors with the smallest ids; each round assigns every part to its
nearest entry (ties to the lower index) and moves each entry to the floored mean of its
parts.

* **Part trees**: vectors are cut into chunks of at most ``CHUNK`` rows.  For each part
  position a chunk's parts are ordered into a balanced kd-tree once, and written with
  the boxes and the component sums of its leaves; every round reads them again.
* **Entry trees**: each codebook gets such a tree in every round.
* **Node pairs**: the two trees are descended together, all pairs of a level at a time.
  A pair is dropped if its boxes are farther apart than the farthest two points of
  another pair of the same part node; against single entries a part node also drops
  those that some other entry beats at every corner of its box.
* A part node left with one entry is assigned whole, by its cached sum and count.  Only
  leaves left with several entries compare their points, in integers: in float64 lanes
  while every product and sum stays under 2**53 (so exact), else in int64.

A task sends one row per (part, entry) it used, whatever its number of vectors; Spark
adds them up and the codebooks (parts x entries, set by parameters) are all that reaches
the driver.  Everything is integer arithmetic, so the result does not depend on how rows
are dealt out.

Cases: rows whose vector is null, empty, or holds null or non-finite components are
dropped; repeated rows each count; a null id comes after all others and is kept; with
fewer vectors than entries the codebooks are that short; an empty table gives an empty
result; vectors of different widths, of a width that cannot be cut, or so large that
their squared distances leave 64 bits raise ValueError.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import held, quoted, read_table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CHUNK, LEAF = 8192, 64
#: Labels with at least this share of the rows (so at most 1 / HOT of them) are joined by broadcast.
HOT = 1e-3


def bounds(n: int, level: int) -> np.ndarray:
    """Row boundaries of the nodes of one level of a balanced tree over n rows; those of deeper levels refine them."""
    return (np.arange((1 << level) + 1) * n) >> level


def depth(n: int, leaf: int) -> int:
    """Levels below the root, so that every node has rows and a leaf about ``leaf`` of them."""
    return max(0, (max(1, n) // leaf).bit_length() - 1)


def grow(points: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the rows in which every tree node is a slice: split at the median of a node's widest dimension."""
    order = np.arange(len(points))
    for level in range(depth(len(points), leaf)):
        edge = bounds(len(points), level)
        here = points[order]
        wide = (np.maximum.reduceat(here, edge[:-1]) - np.minimum.reduceat(here, edge[:-1])).argmax(axis=1)
        node = np.repeat(np.arange(len(wide)), np.diff(edge))
        order = order[np.lexsort((here[np.arange(len(here)), wide[node]], node))]
    return order


def levels(leaves: np.ndarray, merge: np.ufunc) -> list[np.ndarray]:
    """Values of all nodes, root level first, from those of the leaves."""
    out = [leaves]
    while len(out[0]) > 1:
        out.insert(0, merge(out[0][::2], out[0][1::2]))
    return out


class Tree:
    """Points in tree order with the boxes, sums and slices of all nodes."""

    def __init__(self, points: np.ndarray, leaf: int, lo=None, hi=None, total=None):
        self.points, d = points, depth(len(points), leaf)
        at = bounds(len(points), d)[:-1]
        self.depth, self.edges = d, [bounds(len(points), x) for x in range(d + 1)]
        self.lo = levels(np.minimum.reduceat(points, at) if lo is None else lo, np.minimum)
        self.hi = levels(np.maximum.reduceat(points, at) if hi is None else hi, np.maximum)
        self.total = levels(np.add.reduceat(points, at) if total is None else total, np.add)


class Codebook:
    """The entries of one part position with their tree."""

    def __init__(self, entries: np.ndarray):
        order = grow(entries, 1)
        self.entries, self.index = entries, order
        self.tree = Tree(entries[order], 1)
        self.norm = (entries * entries).sum(axis=1)

    def exact_lanes(self, points: np.ndarray) -> bool:
        most = max(int(np.abs(points).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        return points.shape[1] * (2 * most) ** 2 < 1 << 53

    def match(self, parts: Tree, owner: np.ndarray | None, sums: np.ndarray | None, counts: np.ndarray | None) -> None:
        """Assign all points: fill ``owner`` (per point, tree order) or add to ``sums`` and ``counts`` (per entry)."""
        own = self.tree
        q = r = np.zeros(1, dtype=np.int64)
        lq = lr = 0
        single = False  # are r single entries (positions in tree order) by now?
        while True:
            qlo, qhi = parts.lo[lq][q], parts.hi[lq][q]
            rlo, rhi = (own.points[r], own.points[r]) if single else (own.lo[lr][r], own.hi[lr][r])
            near = np.maximum(np.maximum(rlo - qhi, qlo - rhi), 0)
            far = np.maximum(rhi - qlo, qhi - rlo)
            near, far = (near * near).sum(axis=1), (far * far).sum(axis=1)
            reach = np.full(len(parts.lo[lq]), np.iinfo(np.int64).max)
            np.minimum.at(reach, q, far)
            keep = near <= reach[q]
            if single:
                # The entry of least reach stands for its node; others that it beats at every corner go.
                best = np.full(len(reach), -1)
                at = np.flatnonzero(far == reach[q])
                best[q[at[::-1]]] = r[at[::-1]]
                b, e = own.points[best[q]], own.points[r]
                gap = e - b
                # |x-b|^2 - |x-e|^2 = 2 x (e-b) - (|e|^2 - |b|^2), greatest at the corner on e's side.
                lead = 2 * np.where(gap > 0, qhi * gap, qlo * gap).sum(axis=1) - ((e * e).sum(axis=1) - (b * b).sum(axis=1))
                beaten = (lead < 0) | ((lead == 0) & (self.index[r] > self.index[best[q]]))
                keep &= ~(beaten & (r != best[q]))
            q, r = q[keep], r[keep]
            if single:
                alone = np.bincount(q, minlength=len(reach))[q] == 1
                self.settle(parts, lq, q[alone], self.index[r[alone]], owner, sums, counts)
                q, r = q[~alone], r[~alone]
                if lq == parts.depth or not len(q):
                    break
            if lq < parts.depth:
                q, r = np.concatenate((2 * q, 2 * q + 1)), np.concatenate((r, r))
                lq += 1
            for _ in range(2):  # the entry tree is descended twice as fast
                if lr < own.depth:
                    q, r = np.concatenate((q, q)), np.concatenate((2 * r, 2 * r + 1))
                    lr += 1
                elif not single:
                    edge = own.edges[lr]
                    size = np.diff(edge)[r]
                    start = np.repeat(edge[r], size)
                    q, r = np.repeat(q, size), start + np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
                    single = True
        self.compare(parts, q, self.index[r], owner, sums, counts)

    def settle(self, parts, level, nodes, entries, owner, sums, counts) -> None:
        """Whole nodes go to one entry each."""
        edge = parts.edges[level]
        if sums is not None:
            np.add.at(sums, entries, parts.total[level][nodes])
            np.add.at(counts, entries, np.diff(edge)[nodes])
        else:
            for node, entry in zip(nodes.tolist(), entries.tolist(), strict=True):
                owner[edge[node] : edge[node + 1]] = entry

    def compare(self, parts, q, entry, owner, sums, counts) -> None:
        """Leaves with several entries left: distances in integers, lowest index first."""
        if not len(q):
            return
        order = np.lexsort((entry, q))
        q, entry = q[order], entry[order]
        edge, cut = parts.edges[parts.depth], np.flatnonzero(np.diff(q)) + 1
        lanes = np.float64 if self.exact_lanes(parts.points) else np.int64
        points, book, norm = parts.points.astype(lanes), self.entries.astype(lanes), self.norm.astype(lanes)
        rows, owners = [], []
        for leaf, found in zip(q[np.concatenate(([0], cut))].tolist(), np.split(entry, cut), strict=True):
            a, b = edge[leaf], edge[leaf + 1]
            # The point's own square is the same for all entries.
            rows.append(np.arange(a, b))
            owners.append(found[(norm[found] - 2 * (points[a:b] @ book[found].T)).argmin(axis=1)])
        rows, owners = np.concatenate(rows), np.concatenate(owners)
        if sums is None:
            owner[rows] = owners
            return
        order = np.argsort(owners, kind="stable")
        used, first = np.unique(owners[order], return_index=True)
        sums[used] += np.add.reduceat(parts.points[rows[order]], first)
        counts[used] += np.diff(np.append(first, len(owners)))


def to_integers(vectors: pa.Array, parts: int, scale: int) -> np.ndarray:
    """Integer components of non-null vectors of one width, int64 (rows, width)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes[0])
    if (sizes != width).any():
        raise ValueError("vectors must have one width")
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    whole = np.floor(scale * flat)
    if (width // parts) * (2 * np.abs(whole).max()) ** 2 >= 2.0**63:
        raise ValueError("components are too large: squared distances would not fit in 64 bits")
    return whole.astype(np.int64).reshape(-1, width)


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype="<i8").tobytes() if np.abs(a).max(initial=0) >= 1 << 31 else np.ascontiguousarray(a, dtype="<i4").tobytes()


def unpack(raw: bytes, shape: tuple) -> np.ndarray:
    kind = "<i4" if len(raw) == 4 * int(np.prod(shape)) else "<i8"
    return np.frombuffer(raw, dtype=kind).reshape(shape).astype(np.int64)


def kept_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, vector`` of the rows that take part."""
    rows = df.select(quoted(id_col).alias("id"), quoted(label_col).alias("label"), quoted(vector_col).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("vector") > 0) & sound)


def chunked(rows: DataFrame, parts: int, scale: int, chunk: int, leaf: int) -> DataFrame:
    """One row per chunk: ids, labels and, for every part position, points in tree order with leaf boxes and sums."""
    kinds = dict(rows.dtypes)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            vectors = table.column("vector").chunk(0)
            whole = to_integers(vectors, parts, scale)
            n, p = len(whole), whole.shape[1] // parts
            order, points, lo, hi, total = [], [], [], [], []
            for k in range(parts):
                own = whole[:, k * p : (k + 1) * p]
                order.append(grow(own, leaf))
                tree = Tree(own[order[-1]], leaf)
                points.append(tree.points)
                lo.append(tree.lo[-1])
                hi.append(tree.hi[-1])
                total.append(tree.total[-1])
            held_lists = [pa.ListArray.from_arrays([0, n], table.column(c).chunk(0)) for c in ("id", "label")]
            blobs = [pa.array([pack(np.stack(a))], pa.binary()) for a in (order, points, lo, hi, total)]
            waiting.clear()
            return pa.RecordBatch.from_arrays([*held_lists, pa.array([p], pa.int32()), *blobs], names=names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                room = chunk - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(at, room))
                at += room
                if sum(b.num_rows for b in waiting) == chunk:
                    yield flush()
        if sum(b.num_rows for b in waiting):
            yield flush()

    names = ["ids", "labels", "width", "order", "points", "lo", "hi", "total"]
    return rows.mapInArrow(
        build, f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, width int, order binary, points binary, lo binary, hi binary, total binary"
    )


def trees(chunk: dict, parts: int, leaf: int) -> list[Tree]:
    """The part trees of a chunk row, as stored."""
    n, p = len(chunk["ids"]), chunk["width"].as_py()
    m = 1 << depth(n, leaf)
    points = unpack(chunk["points"].as_py(), (parts, n, p))
    boxes = [unpack(chunk[c].as_py(), (parts, m, p)) for c in ("lo", "hi", "total")]
    return [Tree(points[k], leaf, *(b[k] for b in boxes)) for k in range(parts)]


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}


def one_round(chunks: DataFrame, books: np.ndarray, leaf: int) -> np.ndarray:
    """The codebooks after one round: entries become the floored mean of their parts, unused ones stay."""
    parts, k, p = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = [Codebook(b) for b in books]
        sums, counts = np.zeros((parts, k, p), np.int64), np.zeros((parts, k), np.int64)
        for chunk in chunk_rows(batches):
            for i, tree in enumerate(trees(chunk, parts, leaf)):
                codebooks[i].match(tree, None, sums[i], counts[i])
        part, entry = np.nonzero(counts)
        cols = [part, entry, counts[part, entry], *sums[part, entry].T]
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    names = ["part", "entry", "n", *(f"s{i}" for i in range(p))]
    partial = chunks.mapInArrow(add, ", ".join(f"{c} long" for c in names))
    moved = books.copy()
    for row in partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect():
        moved[row["part"], row["entry"]] = [row[c] // row["n"] for c in names[3:]]
    return moved


def coded(chunks: DataFrame, books: np.ndarray, kinds: dict, leaf: int) -> DataFrame:
    """``id, label, code, error`` per vector under the final codebooks."""
    parts = len(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = [Codebook(b) for b in books]
        for chunk in chunk_rows(batches):
            n = len(chunk["ids"])
            order = unpack(chunk["order"].as_py(), (parts, n))
            code, error = np.empty((n, parts), np.uint8 if len(books[0]) <= 256 else np.int64), np.zeros(n, np.int64)
            for i, tree in enumerate(trees(chunk, parts, leaf)):
                owner = np.empty(n, np.int64)
                codebooks[i].match(tree, owner, None, None)
                off = tree.points - books[i][owner]
                code[order[i], i] = owner
                error[order[i]] += (off * off).sum(axis=1)
            texts = ["".join(f"{c:02x}" for c in row) for row in code.tolist()]
            yield pa.RecordBatch.from_arrays(
                [chunk["ids"].values, chunk["labels"].values, pa.array(texts, pa.string()), pa.array(error)], names=["id", "label", "code", "error"]
            )

    return chunks.mapInArrow(encode, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def with_label_error(rows: DataFrame, total: int) -> DataFrame:
    """Add the sum of ``error`` over equal labels.  Hot labels (a bounded number) come by broadcast, the others by a join."""
    sums = held(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "labels")
    hot = sums.where(F.col("n") >= max(1.0, HOT * total)).select(F.col("label").alias("hot_label"), F.col("label_error").alias("hot_error"), F.lit(True).alias("hot"))
    rest = sums.where(F.col("n") < max(1.0, HOT * total)).select(F.col("label").alias("rest_label"), F.col("label_error").alias("rest_error"))
    first = rows.join(F.broadcast(hot), rows["label"].eqNullSafe(hot["hot_label"]), "left").drop("hot_label")
    near = first.where("hot").select("id", "code", "error", F.col("hot_error").alias("label_error"))
    far = first.where("hot IS NULL").drop("hot", "hot_error")
    far = far.join(rest, far["label"].eqNullSafe(rest["rest_label"])).select("id", "code", "error", F.col("rest_error").alias("label_error"))
    return near.unionByName(far)


def vector_codes(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    chunk: int = CHUNK,
    leaf: int = LEAF,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, code, error, label_error`` per kept vector, and the final codebooks (parts, entries, width of a part)."""
    rows = kept_rows(df, id_col, vector_col, label_col)
    order = (F.col("id").isNull(), F.col("id"), F.col("vector"))
    first = rows.orderBy(*order).limit(entries).select("vector").toArrow().column("vector").combine_chunks()
    first = first.chunk(0) if isinstance(first, pa.ChunkedArray) else first
    if not len(first):
        empty = rows.where(F.lit(False)).select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    start = to_integers(first, parts, scale)
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2))
    chunks = held(chunked(rows, parts, scale, chunk, leaf), "chunks")
    for _ in range(rounds):
        books = one_round(chunks, books, leaf)
    final = held(coded(chunks, books, dict(rows.dtypes), leaf), "codes")
    total = final.agg(F.count(F.lit(1))).first()[0]
    return with_label_error(final, total).withColumnRenamed("id", "vec_id"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def q_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = vector_codes(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return out.withColumn("codebooks_sha256", F.lit(digest(books)))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in DuckDB, comparing every part with every entry (integers are exact in its doubles)."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT n, part, min(struct_pack(d := p.xx - 2 * list_inner_product(p.x, b{i}.x) + b{i}.xx, e := e)) AS m
  FROM p JOIN b{i} USING (part) GROUP BY n, part)""")
        if i < rounds:
            steps.append(f"""
u{i} AS (SELECT part, e, pos, floor(sum(v) / count(*)) AS v FROM (SELECT part, a{i}.m.e AS e, unnest(p.x) AS v, unnest(range(len(p.x))) AS pos
  FROM a{i} JOIN p USING (n, part)) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT part, e, x, list_inner_product(x, x) AS xx FROM (SELECT part, e, list(v ORDER BY pos) AS x FROM u{i} GROUP BY part, e
  UNION ALL SELECT part, e, x FROM b{i} ANTI JOIN u{i} USING (part, e)))""")
    body = ",".join(steps)
    last = f"a{rounds}"
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, vec_id, label,
  list_transform(embedding, lambda y: floor({scale} * CAST(y AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
p AS MATERIALIZED (SELECT n, part, x, list_inner_product(x, x) AS xx
  FROM (SELECT n, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS x FROM k, range({parts}) AS t(part))),
b0 AS MATERIALIZED (SELECT part, n - 1 AS e, x, xx FROM p WHERE n <= {entries}),{body},
c AS (SELECT n, string_agg(lpad(lower(to_hex({last}.m.e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum({last}.m.d) AS BIGINT) AS error FROM {last} GROUP BY n),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, e)) AS s FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT s FROM h) AS codebooks_sha256 FROM c JOIN k USING (n)
"""


SQL = sql()
