"""Splitting and sampling (M1–M3).

``hash_split`` / ``hash_sample`` decide each row from a hash of its key
columns, so a row lands on the same side however the data is partitioned and
whichever executor recomputes it.  ``negative_samples`` draws items per user
from a seeded arithmetic hash and keeps the first non-positive draws, as the
reference's per-user loop does, without holding any user's items in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.keys import dense_index_count
from tessera.session import ensure_checkpoint_dir

# Buckets of the key hash.  Fine enough that any fraction a split can state gets its share.
FINE = 1 << 31
# Buckets of the arithmetic form, which any SQL can repeat.
MODULUS = 1000
# Chosen multipliers of the arithmetic split hash and of the draws (primes), and the draws' modulus 2**31 - 1.
P_USER = 7919
P_DRAW = 104729
P_SEED = 15485863
DRAW_A = 48271
DRAW_B = 69621
DRAW_MOD = 2147483647


def key_bucket(keys: Sequence[str], seed: int = 0, modulus: int = FINE) -> Column:
    """Bucket in ``[0, modulus)`` from a 64-bit hash of the key columns (NULL keys hash like any value)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(modulus))


def arithmetic_bucket(k1: str, k2: str | None = None, seed: int = 0, modulus: int = MODULUS) -> Column:
    """Bucket ``(k1·7919 + k2·104729 + seed) mod modulus`` for integer keys (expressible in any SQL)."""
    e = F.col(k1).cast("long") * P_USER
    if k2 is not None:
        e = e + F.col(k2).cast("long") * P_DRAW
    return F.pmod(e + F.lit(seed), F.lit(modulus))


def _placed(bucket: Column | None, keys: Sequence[str], seed: int, modulus: int | None) -> tuple[Column, int]:
    """A bucket column that always lies in ``[0, modulus)``: a NULL bucket is bucket 0, larger ones wrap."""
    if bucket is None:
        return key_bucket(keys, seed), FINE
    m = modulus or MODULUS
    return F.pmod(F.coalesce(bucket.cast("long"), F.lit(0)), F.lit(m)), m


def hash_split(
    df: DataFrame,
    weights: Sequence[float],
    bucket: Column | None = None,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    modulus: int | None = None,
) -> list[DataFrame]:
    """M1: deterministic split by key hash.  ``weights`` are normalised; returns one DataFrame per weight.

    Every row is in exactly one part: a NULL bucket counts as 0 and a bucket
    beyond ``modulus`` (that of the given bucket column) wraps.  A positive weight
    too small for the modulus is refused rather than given no rows.
    """
    place, m = _placed(bucket, keys or df.columns, seed, modulus)
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo = round(acc / total * m)
        acc += w
        hi = round(acc / total * m)
        if w > 0 and hi == lo:
            raise ValueError(f"weight {w} needs a finer bucket than {m}")
        bounds.append((lo, hi))
    tagged = df.withColumn("_bucket", place)
    return [tagged.filter((F.col("_bucket") >= lo) & (F.col("_bucket") < hi)).drop("_bucket") for lo, hi in bounds]


def hash_sample(
    df: DataFrame, fraction: float, bucket: Column | None = None, keys: Sequence[str] | None = None, seed: int = 0, modulus: int | None = None
) -> DataFrame:
    """M2 (deterministic form): rows whose key bucket falls below ``fraction``."""
    place, m = _placed(bucket, keys or df.columns, seed, modulus)
    below = round(fraction * m)
    if fraction > 0 and below == 0:
        raise ValueError(f"fraction {fraction} needs a finer bucket than {m}")
    return df.filter(place < F.lit(below))


def numbered(df: DataFrame, occurrence_col: str = "_occurrence", chunk: int = 100_000) -> DataFrame:
    """The rows with the number of each among its equals (0, 1, ...), whatever the layout.

    Equal rows cannot be told apart, so they are counted (combined before the
    shuffle) and written out again from their count, ``chunk`` at a time by different
    tasks: a row that is a third of the table is never gathered.
    """
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_times"))
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / chunk))))
    last = F.least(F.col("_times"), (F.col("_piece") + 1) * chunk) - 1
    spread = pieces.repartition(*cols, F.col("_piece"))
    return spread.select(*cols, F.explode(F.sequence(F.col("_piece") * chunk, last)).alias(occurrence_col))


def random_split(df: DataFrame, weights: Sequence[float], seed: int, keys: Sequence[str] | None = None) -> list[DataFrame]:
    """M1 (random form): a seeded split of the rows.

    The part of a row follows from its content, its number among equal rows and
    the seed, not from the layout of the data: the split is the same on every
    cluster, and equal rows are drawn independently of each other.  With
    ``keys``, rows of one key stay together instead.
    """
    if keys is not None:
        return hash_split(df, weights, keys=keys, seed=seed)
    return [p.drop("_occurrence") for p in hash_split(numbered(df), weights, seed=seed)]


def bernoulli_sample(
    df: DataFrame, fraction: float, seed: int, keys: Sequence[str] | None = None, draw: Callable[[Column], Column] | None = None, modulus: int = DRAW_MOD
) -> DataFrame:
    """M2 (random form): a seeded sample without replacement, independent of the layout as ``random_split``.

    ``draw`` gives a row's bucket in [0, ``modulus``) from its number among equal rows, for
    draws that SQL can repeat (``draw_index``); by default it is a hash of all columns and that number.
    """
    if keys is not None:
        return hash_sample(df, fraction, keys=keys, seed=seed)
    rows = numbered(df)
    if draw is None:
        return hash_sample(rows, fraction, seed=seed).drop("_occurrence")
    return hash_sample(rows, fraction, bucket=draw(F.col("_occurrence")), modulus=modulus).drop("_occurrence")


def draw_index(user: Column, j: Column, n_items: Column, seed: int = 0) -> Column:
    """The j-th seeded draw of a user, an index in ``[0, n_items)``.

    Three modular squarings mix user and draw non-linearly, so a user's draws
    neither walk the items in fixed steps nor follow another user's.  All
    products stay below 2**63, so any SQL with 64-bit integers can repeat them.
    """
    m = F.lit(DRAW_MOD)
    u = F.pmod(user.cast("long") * P_USER + F.lit(seed * P_SEED), m)
    x = F.pmod(u * u, m)
    y = F.pmod((x + j.cast("long")) * DRAW_A, m)
    z = F.pmod(F.pmod(y * y, m) * DRAW_B + y, m)
    w = F.pmod(F.pmod(z * z, m) * DRAW_A + z, m)
    return F.pmod(w, n_items)


def _draws(users: DataFrame, n_items: int, seed: int, chunk: int) -> DataFrame:
    """Draw rows (user, j, idx) for j in [lo, hi) of each user, split into chunks of ``chunk`` draws.

    Chunk rows are shuffled by (user, chunk) before expansion, so one user with
    very many draws is expanded by many tasks.
    """
    chunks = users.select(
        "user",
        "lo",
        "hi",
        F.explode(F.sequence(F.floor(F.col("lo") / chunk), F.floor((F.col("hi") - 1) / chunk))).alias("c"),
    ).repartition("user", "c")
    j = F.explode(
        F.sequence(
            F.greatest(F.col("lo"), F.col("c") * chunk),
            F.least(F.col("hi"), (F.col("c") + 1) * chunk) - 1,
        )
    )
    d = chunks.select("user", "c", j.alias("j"))
    return d.select("user", "c", "j", draw_index(F.col("user"), F.col("j"), F.lit(n_items), seed).alias("idx"))


def negative_samples(
    positives: DataFrame,
    items: DataFrame,
    seed: int = 0,
    first_draws=lambda n: 2 * n + 10,
    chunk: int = 100_000,
    user_col: str = "user",
    item_col: str = "item",
) -> DataFrame:
    """M3: per user, the first ``n`` drawn items that are not among the user's positives.

    ``n`` is the user's number of distinct positive items; draws stop after
    ``n_items`` as in the reference loop.  The first round draws
    ``first_draws(n)`` per user; users still short draw again (the draw range
    doubles each round) until they have ``n`` or have spent ``n_items`` draws,
    so the result equals an uncapped draw sequence.  Output: (user, item, j).
    """
    ensure_checkpoint_dir(positives.sparkSession)
    # Every round and the final ranking read the positives: compute them once.
    pos = positives.select(F.col(user_col).alias("user"), F.col(item_col).alias("item")).distinct().checkpoint(eager=True)
    need = pos.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    indexed, n_items = dense_index_count(items.select(F.col(item_col).alias("item")).distinct(), "item", "idx")
    if n_items == 0:
        return pos.limit(0).select("user", "item", F.lit(0).cast("long").alias("j"))

    cap = F.least(F.lit(n_items).cast("long"), first_draws(F.col("n")).cast("long"))
    todo = need.select("user", "n", F.lit(0).cast("long").alias("lo"), cap.alias("hi"))
    parts: list[DataFrame] = []
    while True:
        cand = _draws(todo, n_items, seed, chunk).join(indexed, "idx").select("user", "c", "j", "item")
        # Each round's draws are written once; earlier rounds are not rewritten.
        parts.append(cand.join(pos, ["user", "item"], "left_anti").checkpoint(eager=True))
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        got = found.groupBy("user").agg(F.count(F.lit(1)).alias("got"))
        short = (
            todo.join(got, "user", "left")
            .filter((F.coalesce(F.col("got"), F.lit(0)) < F.col("n")) & (F.col("hi") < n_items))
            .select("user", "n", F.col("hi").alias("lo"), F.least(F.lit(n_items).cast("long"), F.col("hi") * 2).alias("hi"))
        ).checkpoint(eager=True)
        # Test emptiness on the materialised set: on an unmaterialised empty result,
        # isEmpty runs as an incremental take over ever more partitions (measured 5× slower).
        if short.isEmpty():
            break
        todo = short
    return _first_n(found, need)


def _first_n(found: DataFrame, need: DataFrame) -> DataFrame:
    """Keep the first ``n`` rows of each user in ``j`` order, ranking within (user, chunk) groups."""
    per_chunk = found.groupBy("user", "c").agg(F.count(F.lit(1)).alias("cn"))
    # Rows per user here = chunks per user, which is small.
    before = per_chunk.select(
        "user",
        "c",
        F.coalesce(
            F.sum("cn").over(Window.partitionBy("user").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("before"),
    )
    ranked = found.withColumn("r", F.row_number().over(Window.partitionBy("user", "c").orderBy("j")))
    out = ranked.join(before, ["user", "c"]).join(need, "user")
    return out.filter(F.col("before") + F.col("r") <= F.col("n")).select("user", "item", "j")
