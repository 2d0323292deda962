"""Near-duplicates by one-permutation MinHash.

A text's set is its distinct word shingles (A-Z lowered; a text with fewer words
than a shingle is one shingle of all of them).  Texts with 100 * intersection
>= 100 * threshold * union are linked, and a component is everything links
connect.

* **Signatures**: one permutation.  Shingle hashes fall into ``BINS`` bins, a bin
  keeps its smallest hash, and an empty bin takes the value of the first
  non-empty one on its own pseudo-random walk over the bins (optimal
  densification).  ``BANDS`` bands of ``ROWS`` bins are the bucket keys; two texts
  at the threshold miss every bucket with probability about (1 - 0.8**4)**40,
  under 1e-9.
* **Equal sets** are one class with one representative, so copies never meet.
* **Stars**: in every bucket each member is compared with one centre only, the
  member that shares the most buckets with others, so a bucket of n members
  gives n - 1 candidates.  Candidates are confirmed on the full sets of strings.
* **No link lost**: two members x and y of a bucket that are not both linked to
  its centre c may still be linked.  Let R and A be what a member lacks of c and
  has beyond c, and q = t / (1 + t) for threshold t.  A link of x and y needs
  ``q (|A_x| + |A_y|) + (1 - q) (|R_x| + |R_y|) - (1 - 2q) |c|`` differences in
  common.  With the differences of a star's members in one order, rarest first, the
  first one that x and y share must leave either of them that many: an equi-join on
  (centre, difference) of those early ones finds all such pairs, and few besides,
  because a rare difference is held by few members.

Components are found by alternating large and small stars on DataFrames; links
and labels stay distributed.

Cases: a text without words has an empty set and is linked with nothing; a null
id is never the smallest, and a component with null ids only has a null
component id and its rows are kept; rows with the same id and text are one
text, kept or dropped together; an empty table gives an empty result; result
columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name, give_back, held, mix64, quoted, read_table, window_codes

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 40, 4
BINS = BANDS * ROWS
WALK = 2048
#: Step between grades of a member's own terms in the join on differences.
GRADE = 1.25
U = np.uint64


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingle_strings(text: bytes, size: int) -> set[bytes]:
    """The exact set, for confirmation (words hold no spaces, so joining them is unambiguous)."""
    words = words_of(text)
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """One 64-bit hash per distinct shingle, ascending.  Distinctness is decided on word ids, not hashes."""
    words = words_of(text)
    n = len(words)
    if not n:
        return np.empty(0, U)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in seen), dtype=U, count=len(seen))
    size = min(size, n)
    _, first = np.unique(window_codes(ids, size), return_index=True)
    out = np.full(len(first), size, dtype=U)
    for k in range(size):
        out = mix64(out * U(0x9E3779B97F4A7C15) + hashes[ids[first + k]])
    return np.sort(out)


@cache
def walks() -> np.ndarray:
    """For every bin, the bins its densification visits."""
    steps = mix64(np.arange(BINS * WALK, dtype=U) + U(0x5851F42D4C957F2D)) % U(BINS)
    return steps.astype(np.int16).reshape(BINS, WALK)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Bucket keys (int64, one per band) of a set of ascending hashes."""
    # Bins are equal ranges of hash values, so the first hash in a bin is its smallest.
    bins = ((hashes >> U(32)) * U(BINS)) >> U(32)
    used, first = np.unique(bins.astype(np.int64), return_index=True)
    full = np.zeros(BINS, dtype=bool)
    full[used] = True
    value = np.zeros(BINS, dtype=U)
    value[used] = hashes[first]
    empty = np.flatnonzero(~full)
    if len(empty):
        source = np.full(len(empty), used[0])
        left = np.arange(len(empty))
        for lo, hi in ((0, 16), (16, WALK)):
            steps = walks()[empty[left], lo:hi]
            hit = full[steps]
            found = hit.any(axis=1)
            source[left[found]] = steps[found, hit[found].argmax(axis=1)]
            left = left[~found]
            if not len(left):
                break
        value[empty] = value[source]
    key = np.arange(BANDS, dtype=U)
    for column in value.reshape(BANDS, ROWS).T:
        key = mix64(key * U(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, node, bands``: node is a 128-bit digest of the set (null if empty)."""
    rows = docs.select(quoted(id_col).alias("doc_id"), F.xxhash64(quoted(text_col)).alias("text_key"), quoted(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bands = [], [], []
            for text in batch.column(2).cast(pa.large_binary()):
                h = shingle_hashes(text.as_py() or b"", shingle)
                sizes.append(len(h))
                nodes.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                bands.append(band_keys(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "node", "bands"],
            )
        give_back()

    return rows.mapInArrow(sign, f"doc_id {kind}, text_key long, n_shingles long, node binary, bands array<long>")


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)`` but the roots: root is the smallest node of its component.

    Alternating large and small stars: every node is re-linked to the smallest
    node it knows, until all links lead straight to roots (a number of rounds
    that grows with the logarithm of the component size).
    """

    def star(links: DataFrame, large: bool) -> DataFrame:
        # (u, v) pairs to look at from u: all neighbours (large) or the smaller ones only (small).
        if large:
            seen = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            seen = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        near = seen.join(least, "u")
        if large:
            return near.where("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = near.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def settled(links: DataFrame) -> bool:
        """No node has two links, and none that is linked to has a link itself."""
        ends = links.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
            links.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("in"))
        )
        sums = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
        return sums.where("out > 1 OR (out = 1 AND in = 1)").agg(F.count(F.lit(1))).collect()[0][0] == 0

    links = edges.select("a", "b").where("a <> b")
    while True:
        links = held(star(star(links, True), False), "links")
        if settled(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def jaccard(pairs: DataFrame, texts: DataFrame, shingle: int, differences: bool = False) -> DataFrame:
    """Add ``shared`` and ``union`` (set sizes) to pairs (a, b), from the full sets of strings.

    With ``differences`` also ``added`` and ``removed``: hashes of what ``a`` has
    beyond ``b``, and lacks of it.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def hashes(items: set[bytes], salt: int) -> list[int]:
        # Signed 64-bit values in a fixed order.
        return sorted(xxhash.xxh3_64_intdigest(x, salt) - (1 << 63) for x in items)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            shared, union, added, removed = [], [], [], []
            for b, ta, tb in zip(batch.column(1), batch.column(2).cast(pa.large_binary()), batch.column(3).cast(pa.large_binary()), strict=True):
                if b.as_py() != last:  # rows of one centre mostly follow each other
                    last, known = b.as_py(), shingle_strings(tb.as_py(), shingle)
                other = shingle_strings(ta.as_py(), shingle)
                both = len(other & known)
                shared.append(both)
                union.append(len(other) + len(known) - both)
                added.append(hashes(other - known, 1) if differences else None)
                removed.append(hashes(known - other, 2) if differences else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(union, pa.int64()), pa.array(added, longs), pa.array(removed, longs)],
                names=["a", "b", "shared", "union", "added", "removed"],
            )
        give_back()

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(compare, "a binary, b binary, shared long, union long, added array<long>, removed array<long>")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_shingles, component_id, kept``."""
    signed = held(signatures(docs, id_col, text_col, shingle), "signatures")
    some = signed.where("node IS NOT NULL")
    # One representative text per class of equal sets: the smallest id, nulls last.
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key")
    classes = held(
        some.groupBy("node").agg(F.min(order).alias("r"), F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")),
        "classes",
    )
    # A class stands in a bucket once, also when two of its bands had equal keys.
    spread = classes.select("node", "n", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = held(spread.join(shared, "bucket"), "members")
    wanted = members.select("node").distinct().join(classes.select("node", "r.doc_id", "r.text_key"), "node")
    source = docs.select(quoted(id_col).alias("doc_id"), F.xxhash64(quoted(text_col)).alias("text_key"), quoted(text_col).alias("text"))
    # Equal (id, text) rows give a class its text more than once: keep one.
    match = wanted["doc_id"].eqNullSafe(source["doc_id"]) & (wanted["text_key"] == source["text_key"])
    texts = held(source.join(wanted, match).select("node", "text").dropDuplicates(["node"]), "texts")

    link = f"100 * shared >= {percent} * union"
    # Centre of a bucket: the member with the most company over all its buckets (then the smaller
    # node), which is the text the others are copies of, or close to it.
    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    ranked = members.join(company, "node").withColumn("rank", F.struct((-F.col("company")).alias("k"), F.col("node").alias("c")))
    centres = ranked.groupBy("bucket").agg(F.min("rank").alias("m")).select("bucket", "m.c")
    star = members.join(centres, "bucket").where("node <> c").select(F.col("node").alias("a"), F.col("c").alias("b")).distinct()
    scored = held(jaccard(star, texts, shingle, differences=True), "scored")
    links = scored.where(link).select("a", "b")
    roots = connected(links)
    rest = across(scored, roots, link, percent)
    fits = classes.select("node", "n")
    rest = rest.join(fits.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(fits.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    rest = held(rest.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b"), "rest")
    more = held(jaccard(rest, texts, shingle).where(link).select("a", "b"), "more")
    if not more.isEmpty():
        roots = connected(links.unionByName(more))

    def rooted(df: DataFrame) -> DataFrame:
        return df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    found = rooted(classes.select("node", "first_id"))
    label = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = found.join(label, "root").select("node", "component_id")
    out = signed.select("doc_id", "text_key", "n_shingles", "node").join(labelled, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def across(scored: DataFrame, roots: DataFrame, link: str, percent: int) -> DataFrame:
    """Pairs (a, b) compared with the same centre, a not linked to it, in different components, that can be linked.

    A link needs o differences in common, o = (excess of x + own of y) / (100 + percent), so
    the first one they share, in an order common to the star, leaves each of them o of its
    own or more.  The rarest differences of the star come first: what all members have
    against an odd centre comes last and brings no pair together.  ``g`` grades y's own terms,
    so that x offers each grade only the differences that can meet its o.
    """
    root = roots.select(F.col("node").alias("a"), "root")
    both = 100 + percent
    known = scored.join(root, "a", "left").withColumn("root", F.coalesce("root", "a")).withColumn("linked", F.expr(link))
    odd = known.where("NOT linked").select("b").distinct()
    # In units of 1 / (100 + percent): what a member's own differences ask for, and what asks beyond the
    # other's (more, the farther it is from the centre, whose size is shared + removed).
    own = F.size("removed") * 100 + F.size("added") * percent
    excess = own - (F.col("shared") + F.size("removed")) * (100 - percent)
    every = F.concat("added", "removed")
    flat = known.join(odd, "b", "left_semi").select("a", "b", "root", "linked", own.alias("own"), excess.alias("excess"), F.size(every).alias("size"), F.explode(every).alias("e"))
    # Rarest differences first, one order for all members of a star; a member holds ``left`` of its own from each on.
    often = flat.groupBy("b", "e").agg(F.count(F.lit(1)).alias("f"))
    order = Window.partitionBy("b", "a").orderBy("f", "e")
    placed = flat.join(often, ["b", "e"]).withColumn("left", F.col("size") - F.row_number().over(order) + 1)
    # Two members that may be linked have sizes that make o >= excess / 100, whichever the other is.
    placed = held(placed.where("f > 1 AND 100 * left >= excess").drop("f"), "differences")

    def grade(value):
        return F.floor(F.log(F.greatest(value, F.lit(0)) + 1.0) / math.log(GRADE)).cast("int")

    y = placed.where(F.col("left") * both > F.col("own")).select(F.col("a").alias("y"), "b", "e", F.col("root").alias("yroot"), F.col("own").alias("yown"), F.col("left").alias("yleft"), grade(F.col("own")).alias("g"))
    # x meets only grades of y's own terms that its difference can still serve.
    grades = F.sequence(F.greatest(grade(F.col("excess") * percent / 100.0) - 1, F.lit(0)), F.greatest(grade(F.col("left") * both - F.col("excess")) + 1, F.lit(0)))
    x = placed.where("NOT linked").select("a", "b", "e", "root", "excess", "left", F.explode(grades).alias("g"))
    needed = F.col("excess") + F.col("yown") <= F.least("left", "yleft") * both
    met = x.join(y, ["b", "e", "g"]).where((F.col("root") != F.col("yroot")) & needed).select(F.least("a", "y").alias("a"), F.greatest("a", "y").alias("b"))
    return met.distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without those near-duplicate to one with a smaller id (columns of ``docs``)."""
    lost, key = free_name("_gone", docs.columns), free_name("_key", docs.columns)
    gone = components(docs, id_col, text_col, **options).where(~F.col("kept")).select(F.col("doc_id").alias(lost), F.col("text_key").alias(key)).distinct()
    return docs.join(gone, quoted(id_col).eqNullSafe(F.col(lost)) & (F.xxhash64(quoted(text_col)) == F.col(key)), "left_anti")


def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return components(docs, shingle=2).drop("text_key")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS g FROM d),
c AS (SELECT g, min(doc_id) AS rep FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT rep, len(g) AS n, unnest(g) AS x FROM c),
o AS (SELECT a.rep AS x, b.rep AS y, count(*) AS shared, any_value(a.n) + any_value(b.n) AS total
  FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM o WHERE 100 * shared >= 80 * (total - shared) UNION SELECT y, x FROM o WHERE 100 * shared >= 80 * (total - shared)),
r AS (SELECT rep AS x, rep AS y FROM c UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x, min(y) AS root FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(k.root, s.doc_id) AS component_id, coalesce(k.root, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON s.g = c.g AND len(s.g) > 0 LEFT JOIN k ON k.x = c.rep
"""
