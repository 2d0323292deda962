"""Language-model scores from a hashed maximum-entropy model.

**Counts.** Words (A-Z lowered) and one end token per text are counted over all
training texts; the table grows with the corpus and stays distributed.  Only its
``known_words`` most frequent words (a documented bound) are shipped to tasks, so
frequent words are never shuffled when texts are scored; the rare rest of each
text meets the table in a join.

**Ranks.** Texts are split and looked up once: the ranks of their words, and what
the model needs of words outside the shipped table, are written to the shared
folder, where every gradient round and the scoring read them.

**Model.** The ``CLASSES * SLOTS`` most frequent words form classes of ``SLOTS``
neighbours in rank; all other words are one further class.  The probability of
a word after its history is P(class | history) * P(word | class, history), both
softmaxes over hashed features: a bias, the previous word, the previous two
words, and the word before the previous one (skip).  Within the class of other
words a word has its add-one share of that class's counts, so unseen words have
a probability too.

**Training.** Full-batch gradient rounds over all training texts: every task
sums observed and expected feature counts over its texts, Spark sums those in
two levels by block of rows (observed counts do not depend on the model, so only
the first round counts and sends them), and the update moves each weight along its gradient
(observed - expected), scaled as in iterative scaling:
``rate * log((observed + prior) / (expected + prior))``.  Weights, and what is sent to
the driver, have a fixed size.

**Scoring.** Texts are scored in numpy batches of ``BATCH`` tokens; only the
feature rows a batch uses are read.

Cases: a null or empty text is its end token alone; without training texts every
count is zero; a null id counts as training; very long texts are scored in
batches; repeated rows are scored each and count as often as they occur; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import give_back, held, mix64, quoted, read_table

END = ""  # no word is empty
CLASSES, SLOTS = 32, 32
BITS = 14
BATCH = 1 << 16
ROUNDS = 3
RATE = 0.6
PRIOR = 4.0
BLOCKS = 64
KNOWN_WORDS = 200_000
FLUSH = 1 << 20
#: Texts are split in groups of about this many bytes, or one text.
GROUP_BYTES = 1 << 21
#: A task of a gradient round sends tables of a fixed size, so it should see this many tokens at least.
TASK_TOKENS = 8_000_000
U = np.uint64


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that end as soon as they reach ``most`` together."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = min(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most)) + 1, len(ends))
        yield lo, hi
        lo = hi


def text_groups(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of about ``GROUP_BYTES`` at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for lo, hi in groups(sizes, GROUP_BYTES):
        yield lo, texts.slice(lo, hi - lo)


# -- counts ----------------------------------------------------------------------


def count_words(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` over all texts, the end token (the empty word) included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                seen.update(words_of(text.as_py()))
            seen[b""] += batch.num_rows
            if len(seen) > FLUSH:
                yield flush()
        yield flush()
        give_back()

    return texts.select(quoted(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """The most frequent words, by rank, with what scoring needs of them."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int  # of the training texts
    distinct: int
    index: dict[bytes, int] = field(init=False, repr=False)
    hashes: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.index = {w: i for i, w in enumerate(self.words)}
        self.hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), dtype=U, count=len(self.words))
        # The last entries stand for words outside the table.
        self.head = min(CLASSES * SLOTS, len(self.words))
        inside = int(self.counts[: self.head].sum())
        self.other_total = math.log10(self.tokens - inside + self.distinct - self.head + 1)
        self.log_count = np.log10(self.counts + 1.0)


def lexicon(counts: DataFrame, known_words: int) -> Lexicon:
    """The words above a count threshold that at most ``known_words`` words reach, so only those leave the executors.

    The threshold comes from a histogram of the counts on a logarithmic scale (a few hundred rows).
    """
    level = F.floor(F.log(F.col("n").cast("double")) * 32)
    histogram = sorted(
        counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).collect(),
        key=lambda r: -r["level"],
    )
    words, least = 0, None
    for r in histogram:
        words += r["words"]
        if words > known_words:
            break
        least = r["least"]
    top = [] if least is None else counts.where(F.col("n") >= least).collect()
    top.sort(key=lambda r: (-r["n"], r["word"].encode()))
    tokens, distinct = sum(r["n"] for r in histogram), sum(r["words"] for r in histogram)
    return Lexicon([r["word"].encode() for r in top], np.array([r["n"] for r in top], dtype=np.int64), tokens, distinct)


# -- model ------------------------------------------------------------------------


def look_up(texts: list[list[bytes]], lex: Lexicon) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(ranks of all tokens, -1 outside the table; tokens per text; words outside the table, where they stand)."""
    flat: list[bytes] = []
    for words in texts:
        flat += words
        flat.append(b"")
    rank = np.fromiter(map(lex.index.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    missing = rank < 0
    missing[np.cumsum(sizes) - 1] = False  # the end token is in no history
    at = np.flatnonzero(missing)
    return rank, sizes, [flat[i] for i in at.tolist()], at


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=len(words))


class Tokens:
    """Token ranks and history features of several texts, in numpy."""

    def __init__(self, texts: list[list[bytes]], lex: Lexicon) -> None:
        rank, sizes, rare, _ = look_up(texts, lex)
        self._set(rank, sizes, hashes_of(rare), lex)

    @classmethod
    def ranked(cls, rank: np.ndarray, sizes: np.ndarray, outside: np.ndarray, lex: Lexicon) -> Tokens:
        """From ranks, tokens per text, and the hashes of the words outside the table."""
        out = cls.__new__(cls)
        out._set(rank, sizes, outside, lex)
        return out

    def _set(self, rank: np.ndarray, sizes: np.ndarray, outside: np.ndarray, lex: Lexicon) -> None:
        self.rank = rank
        self.sizes = sizes
        self.begin = np.cumsum(self.sizes) - self.sizes
        if len(lex.hashes):
            hashes = lex.hashes[self.rank]
        else:
            hashes = np.zeros(len(self.rank), U)
        missing = self.rank < 0
        missing[self.begin + self.sizes - 1] = False  # the end token is in no history
        hashes[missing] = outside
        start = U(0x1F83D9ABFB41BD6B)
        one = np.roll(hashes, 1)
        two = np.roll(hashes, 2)
        one[self.begin] = two[self.begin] = start
        two[(self.begin + 1)[self.sizes > 1]] = start
        self.features = [
            mix64(one * U(0x9E3779B97F4A7C15) + U(1)),
            mix64(mix64(one * U(0xC2B2AE3D27D4EB4F) + U(2)) + two * U(0x165667B19E3779F9)),
            mix64(two * U(0x27D4EB2F165667C5) + U(3)),
        ]
        head = (self.rank >= 0) & (self.rank < lex.head)
        self.cls = np.where(head, self.rank // SLOTS, CLASSES)
        self.slot = np.where(head, self.rank % SLOTS, 0)


RANKED = "struct<ranks: binary, outside: binary>"


def ranked(docs: DataFrame, lex, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` with the ranked form of the texts, a number ``row`` each, and their words outside the table with counts.

    Numbers follow the layout, so the result is written (``held``) before they are used.
    """
    rows = docs.select(*[quoted(c) for c in columns], quoted(text_col).cast("string"))
    kinds = "".join(f"`{c.replace('`', '``')}` {k}, " for c, k in rows.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = lex.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, some in text_groups(batch.column(len(columns))):
                rank, sizes, words, at = look_up([words_of(x.as_py()) for x in some.cast(pa.large_binary())], known)
                ends = np.cumsum(sizes)
                cuts = np.searchsorted(at, np.concatenate(([0], ends)))
                tails = [Counter(words[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                form = [packed(rank.astype(np.int32), ends), packed(hashes_of(words), cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(lo, len(some)) for c in batch.columns[:-1]],
                        pa.StructArray.from_arrays(form, names=["ranks", "outside"]),
                        pa.array(range(row, row + len(some)), pa.int64()),
                        pa.array([[w.decode() for w in t] for t in tails], pa.list_(pa.string())),
                        pa.array([list(t.values()) for t in tails], pa.list_(pa.int32())),
                    ],
                    names=[*columns, "ranked", "row", "rare", "rare_n"],
                )
                row += len(some)
        give_back()

    return rows.mapInArrow(run, f"{kinds}ranked {RANKED}, row long, rare array<string>, rare_n array<int>")


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value per text from its stretch of a column (``ends``: where each stretch ends)."""
    offsets = np.concatenate(([0], ends)).astype(np.int64) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many per text) of a column made by ``packed``."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind), sizes


def token_groups(form: pa.StructArray, lex: Lexicon) -> Iterator[tuple[int, Tokens]]:
    """(first row, tokens) of ranked texts, about four batches of tokens at a time."""
    ranks, outside = form.field("ranks"), form.field("outside")
    sizes = pc.binary_length(ranks).to_numpy(zero_copy_only=False) // 4
    for lo, hi in groups(sizes, 4 * BATCH):
        rank, n = unpacked(ranks.slice(lo, hi - lo), np.int32)
        hashes, _ = unpacked(outside.slice(lo, hi - lo), U)
        yield lo, Tokens.ranked(rank.astype(np.int64), n, hashes, lex)


def rows_of(features: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of the weight table for each feature; row 0 is the bias of classes (see ``Model``)."""
    return [(f >> U(64 - BITS)).astype(np.int64) for f in features]


class Model:
    """Weights of both softmaxes: ``2**BITS`` hashed rows each, and biases (of classes; of words per class).

    Tables are held by output (one contiguous line per class or slot), so
    gathering, softmax and summing run along whole batches.
    """

    def __init__(self, lex: Lexicon) -> None:
        n = 1 << BITS
        self.class_rows = np.zeros((CLASSES + 1, n), dtype=np.float32)
        self.word_rows = np.zeros((SLOTS, n), dtype=np.float32)
        self.fresh = True  # biases only, so far
        counts = np.zeros(CLASSES * SLOTS)
        counts[: lex.head] = lex.counts[: lex.head]
        table = counts.reshape(CLASSES, SLOTS)
        other = lex.tokens - counts.sum() + 1.0
        self.class_bias = np.log(np.append(table.sum(axis=1), other) + 1e-6).astype(np.float32)
        self.word_bias = np.log(table.T + 1e-6).astype(np.float32)

    def classes(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(class) by output line, for a batch of positions."""
        return softmax(gather(self.class_rows, rows, np.repeat(self.class_bias[:, None], len(rows[0]), axis=1)))

    def words(self, cls: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        return softmax(gather(self.word_rows, rows, self.word_bias[:, cls]))


def gather(table: np.ndarray, rows: list[np.ndarray], out: np.ndarray) -> np.ndarray:
    held_row = np.empty(out.shape[1], dtype=table.dtype)
    for line, into in zip(table, out, strict=True):
        for r in rows:
            np.take(line, r, out=held_row, mode="clip")  # rows are in range; other modes copy through a buffer
            into += held_row
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def batches_of(tokens: Tokens) -> Iterator[tuple[slice, np.ndarray, list[np.ndarray], np.ndarray, list[np.ndarray]]]:
    """(slice, classes, class rows, indices with a head word, their word rows) of ``BATCH`` tokens at a time."""
    for lo in range(0, len(tokens.rank), BATCH):
        part = slice(lo, min(lo + BATCH, len(tokens.rank)))
        cls = tokens.cls[part]
        features = [f[part] for f in tokens.features]
        head = np.flatnonzero(cls < CLASSES)
        salt = cls[head].astype(U) * U(0x9FB21C651E98DF25)
        yield part, cls, rows_of(features), head, rows_of([mix64(f[head] ^ salt) for f in features])


def count_into(table: np.ndarray, line: np.ndarray, rows: list[np.ndarray]) -> None:
    at = line * table.shape[1]
    table += np.bincount(np.concatenate([at + r for r in rows]), minlength=table.size).reshape(table.shape)


def add_expected(into: np.ndarray, rows: list[np.ndarray], p: np.ndarray) -> None:
    n = into.shape[1]
    every = np.concatenate(rows)
    weights = np.empty((len(rows), p.shape[1]))
    for line, w in zip(into, p, strict=True):
        weights[:] = w
        line += np.bincount(every, weights=weights.ravel(), minlength=n)


def widths(model: Model) -> tuple[int, ...]:
    """Lines of the tables a round sends: expected class and word counts, in the first round observed ones before them."""
    return (CLASSES + 1, SLOTS) * (2 if model.fresh else 1)


class Sums:
    """Feature counts of one task, by output line: the model's expectations, after the observed counts in the first round."""

    def __init__(self, model: Model) -> None:
        n = 1 << BITS
        self.model = model
        self.tables = [np.zeros((w, n), dtype=np.float32) for w in widths(model)]
        # A model of biases expects the same of every position: uses per row (and class) are enough.
        self.uses = np.zeros(n)
        self.word_uses = np.zeros((CLASSES, n), dtype=np.float32)

    def add(self, tokens: Tokens) -> None:
        n, model = 1 << BITS, self.model
        expected, expected_words = self.tables[-2:]
        for part, cls, class_rows, head, word_rows in batches_of(tokens):
            head_cls = cls[head]
            if model.fresh:
                count_into(self.tables[0], cls, class_rows)
                count_into(self.tables[1], tokens.slot[part][head], word_rows)
                self.uses += np.bincount(np.concatenate(class_rows), minlength=n)
                count_into(self.word_uses, head_cls, word_rows)
            else:
                add_expected(expected, class_rows, model.classes(class_rows))
                if len(head):
                    add_expected(expected_words, word_rows, model.words(head_cls, word_rows))

    def finish(self) -> list[np.ndarray]:
        if self.model.fresh:
            share = softmax(self.model.class_bias[:, None].astype(np.float64))
            self.tables[2] += share * self.uses
            self.tables[3] += softmax(self.model.word_bias.astype(np.float64)) @ self.word_uses
        return self.tables


def fold(table: pa.Table) -> pa.Table:
    """Sum the parts of one block."""
    total = None
    for blob in table.column("sums"):
        part = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), dtype=np.float32)
        total = part.copy() if total is None else total + part
    return pa.table(
        {
            "block": table.column("block").slice(0, 1),
            "part": table.column("part").slice(0, 1),
            "sums": pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary()),
        }
    )


def gradient_round(texts: DataFrame, text_col: str, lex, model: Model) -> list[np.ndarray]:
    """Expected feature counts over all texts under the current model, in the first round after the observed ones.

    ``text_col`` holds texts or their ranked form.  Input splits are joined
    (without a shuffle) until a task has enough tokens for the tables it sends;
    all cores keep a task or two.
    """
    if dict(texts.dtypes)[text_col] == "string":
        texts, text_col = ranked(texts, lex, [], text_col), "ranked"
    tasks = max(2 * texts.sparkSession.sparkContext.defaultParallelism, lex.value.tokens // TASK_TOKENS)
    width = math.isqrt(tasks)
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part, known = Sums(shared.value), TaskContext.get().partitionId() % width, lex.value
        some = False
        for batch in batches:
            for _, tokens in token_groups(batch.column(0), known):
                out.add(tokens)
                some = True
        if some:
            whole = [np.array_split(t, BLOCKS, axis=1) for t in out.finish()]
            for b in range(BLOCKS):
                blob = b"".join(t[b].tobytes() for t in whole)
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([b], pa.int32()), "part": pa.array([part], pa.int32()), "sums": pa.array([zstandard.ZstdCompressor(level=1).compress(blob)], pa.binary())}
                )
            del out, whole
        give_back()

    ddl = "block int, part int, sums binary"
    parts = texts.select(quoted(text_col)).coalesce(tasks).mapInArrow(sums, ddl)
    # Two levels of about the square root of the tasks each, so no sum takes a part from every task.
    rows = parts.groupBy("block", "part").applyInArrow(fold, ddl).groupBy("block").applyInArrow(fold, ddl).collect()
    n = (1 << BITS) // BLOCKS
    tables = [np.zeros((w, 1 << BITS), dtype=np.float32) for w in widths(model)]
    for r in rows:
        flat, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["sums"]), dtype=np.float32), 0
        for t in tables:
            size = n * t.shape[0]
            t[:, r["block"] * n : (r["block"] + 1) * n] = flat[at : at + size].reshape(-1, n)
            at += size
    return tables


def train(texts: DataFrame, text_col: str = "text", known_words: int = KNOWN_WORDS, rounds: int = ROUNDS) -> tuple[DataFrame, Lexicon, Model]:
    """(distributed word counts, shipped words, trained model) from all texts."""
    counts = held(count_words(texts, text_col), "words")
    lex = lexicon(counts, known_words)
    shared = texts.sparkSession.sparkContext.broadcast(lex)
    rows = held(ranked(texts, shared, [], text_col).select("ranked"), "ranked")
    return counts, lex, fit(rows, shared, rounds)


def fit(rows: DataFrame, shared, rounds: int = ROUNDS) -> Model:
    """The model trained on all ranked texts, with the words as they were shipped to rank them."""
    lex = shared.value
    model = Model(lex)
    for _ in range(rounds if lex.tokens else 0):
        tables = gradient_round(rows, "ranked", shared, model)
        if model.fresh:
            seen, seen_words = tables[:2]
        expected, expected_words = tables[-2:]
        model.class_rows += (RATE * np.log((seen + PRIOR) / (expected + PRIOR))).astype(np.float32)
        model.word_rows += (RATE * np.log((seen_words + PRIOR) / (expected_words + PRIOR))).astype(np.float32)
        model.fresh = False
    return model


# -- scores -----------------------------------------------------------------------


def score_tokens(tokens: Tokens, lex: Lexicon, model: Model) -> np.ndarray:
    """log10 probability of every token; of other words only what does not depend on their rare count."""
    out = np.empty(len(tokens.rank))
    for part, cls, class_rows, head, word_rows in batches_of(tokens):
        p = model.classes(class_rows)
        score = np.log10(np.maximum(p[cls, np.arange(len(cls))], 1e-30).astype(np.float64))
        if len(head):
            q = model.words(cls[head], word_rows)
            score[head] += np.log10(np.maximum(q[tokens.slot[part][head], np.arange(len(head))], 1e-30).astype(np.float64))
        out[part] = score
    other = tokens.cls == CLASSES
    out[other] -= lex.other_total
    known = other & (tokens.rank >= 0)
    out[known] += lex.log_count[tokens.rank[known]]
    return out


SCORED = "row long, n_tokens long, known_tokens long, known_sum double, model_sum double"


def score(docs: DataFrame, counts: DataFrame, lex: Lexicon, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row."""
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    return score_ranked(held(ranked(rows, shared, ["doc_id"]), "ranked"), counts, shared, model)


def score_ranked(rows: DataFrame, counts: DataFrame, shared_lex, model: Model) -> DataFrame:
    """The scores from what ``ranked`` made, written before."""
    lex, shared_model = shared_lex.value, rows.sparkSession.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, current = shared_lex.value, shared_model.value
        for batch in batches:
            for lo, tokens in token_groups(batch.column(2), known):
                inside = tokens.rank >= 0
                logs = np.zeros(len(inside))
                logs[inside] = known.log_count[tokens.rank[inside]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, len(tokens.sizes)),
                        batch.column(1).slice(lo, len(tokens.sizes)),
                        pa.array(tokens.sizes),
                        pa.array(np.add.reduceat(inside.astype(np.int64), tokens.begin)),
                        pa.array(np.add.reduceat(logs, tokens.begin)),
                        pa.array(np.add.reduceat(score_tokens(tokens, known, current), tokens.begin)),
                    ],
                    names=["doc_id", "row", "n_tokens", "known_tokens", "known_sum", "model_sum"],
                )
        give_back()

    scored = rows.select("doc_id", "row", "ranked").mapInArrow(run, f"doc_id {kind}, {SCORED}")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("k"))
    met = rare.join(counts, "word").groupBy("row").agg(F.sum("k").alias("rare_tokens"), F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("rare_sum"))
    out = scored.join(met, "row", "left")
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("known_tokens") + F.coalesce("rare_tokens", F.lit(0))).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("known_sum") + rare_sum - F.col("n_tokens") * F.lit(math.log10(lex.tokens + lex.distinct + 1))).alias("base_score"),
        (F.col("model_sum") + rare_sum).alias("score"),
    )


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def q_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = held(count_words(docs.where(~held_out(F.col("doc_id")))), "words")
    shared = spark.sparkContext.broadcast(lexicon(counts, KNOWN_WORDS))
    rows = held(ranked(docs, shared, ["doc_id"]), "ranked")
    model = fit(rows.where(~held_out(F.col("doc_id"))), shared)
    return score_ranked(rows, counts, shared, model).withColumn("held_out", held_out(F.col("doc_id")))
