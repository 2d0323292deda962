"""Packing token pieces into sequences by a configuration linear program.

``tokenize_pieces`` turns documents into pieces of at most ``capacity`` tokens;
``pack`` gives every piece a sequence and an offset.  Only the histogram of
piece lengths (at most ``capacity`` numbers) reaches the driver.  There:

* A configuration is a multiset of lengths that fits one sequence.  The linear
  program asks for the fewest (fractional) configurations that cover the
  histogram.  It is solved by multiplicative weights: every length has a
  weight, which falls as it is covered; a bounded-knapsack dynamic program
  prices the best configuration under the current weights.
* The solution is rounded to whole configurations, never covering a length more
  often than it occurs, and the program is solved again for what is left; the
  last rest is packed by best fit decreasing, also on the histogram.
* Programs over the long pieces first, over the short ones that exceed their free
  space, and over all lengths are compared; the plan of fewest sequences is taken.

The result is a table of intervals "pieces of length L with rank in [a, b) go
to these slots", whose size depends on the capacity, not on the corpus.  A
piece's rank among those of its length is its rank within its task plus the
counts of earlier tasks, so no group of equal lengths is ever gathered.

Cases: a null or empty text is the end token alone; a document of more than
``capacity`` tokens is cut and only its last piece may be shorter; repeated
documents are packed as often as they occur; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tessera.llm.common import free_name, give_back, quoted, read_table
from tessera.session import scratch_path

CAPACITY = 4096
ITERATIONS = 200
SOLVES = 6
RATE = 1.0
#: Share of the scarcest size that one step covers.
STEP = 0.5
#: A configuration's value starts from size ** POWER: few long pieces before many short ones.
POWER = 1.5
#: The program's sizes are in 1/1024 of the capacity; the first program is over pieces above 1/4 of it.
UNITS = 1024
SMALL = 4
#: A plan this share (or one sequence) above the volume bound, which no plan can beat, is not tried again.
GAP = 0.001


def _byte_units() -> list[str]:
    """The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others for 256, 257, ..."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


_BYTE_UNITS = _byte_units()


class WordCache:
    """Token ids (little-endian uint32 bytes) per white-space separated word, as the tokenizer gives them.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words in order.  A word of letters with closing
    punctuation splits further into the two.  The cache starts anew when full.
    """

    LIMIT, LONG = 1 << 19, 64

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _look(self, word: bytes) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            ids = self._encode(word)
            if len(word) <= self.LONG:
                self.known[word] = ids
        return ids

    def _encode(self, word: bytes) -> bytes:
        core = word.rstrip(b".,;:!?")
        text = core.decode()
        low = text.lower()
        # Latin letters only: normalisation leaves their lower case as it is, and they are one unit
        # of the tokenizer, so its model can be asked directly (in its byte alphabet).
        if text.isalpha() and low.isalpha() and low.isprintable() and max(low) < "\u0250" and len(low) == len(text):
            if len(core) < len(word):
                return self._look(core) + self._look(word[len(core) :])
            if low != text:
                return self._look(low.encode())
            units = "".join([_BYTE_UNITS[b] for b in core])
            return np.array([t.id for t in self.tokenizer.model.tokenize(units)], dtype="<u4").tobytes()
        return np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: bytes) -> bytes:
        words = text.split()
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            return b"".join(map(self._look, words))


@cache
def word_cache(path: str) -> WordCache:
    return WordCache(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenize_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (uint32 bytes)."""
    path = tokenizer_path or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")
    kind = docs.select(quoted(id_col)).dtypes[0][1]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_cache(path)
        try:
            for batch in batches:
                rows: list[tuple] = []
                source: list[int] = []
                for k, text in enumerate(batch.column(1).cast(pa.large_binary())):
                    ids = words.ids(text.as_py() or b"") + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((piece, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
                        source.append(k)
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                out = {
                    "doc_id": batch.column(0).take(pa.array(source, pa.int64())),
                    "piece": pa.array(cols[0], pa.int32()),
                    "start": pa.array(cols[1], pa.int64()),
                    "length": pa.array(cols[2], pa.int64()),
                    "ids_crc32": pa.array(cols[3], pa.int64()),
                }
                if keep_ids:
                    out["ids"] = pa.array(cols[4], pa.binary())
                yield pa.RecordBatch.from_pydict(out)
        finally:
            # The task is over: its words are not kept for the stages that follow in this worker.
            words.known.clear()
            give_back()

    return docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")).mapInArrow(pieces, schema)


def price(values: np.ndarray, counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of greatest value: a bounded knapsack over sizes 1..capacity.

    Copies of a size are split into powers of two, so each enters the dynamic
    program about log(copies) times; one vector step per entry.
    """
    entries: list[tuple[int, int]] = []
    for size in np.flatnonzero(counts).tolist():
        left, k = min(int(counts[size]), capacity // size), 1
        while left > 0:
            take = min(k, left)
            entries.append((size, take))
            left -= take
            k *= 2
    best = np.zeros(capacity + 1)
    took = np.zeros((len(entries), capacity + 1), dtype=bool)
    for i, (size, take) in enumerate(entries):
        room = size * take
        better = best[:-room] + values[size] * take
        won = better > best[room:] + 1e-12
        took[i, room:] = won
        best[room:][won] = better[won]
    found: dict[int, int] = {}
    room = int(np.argmax(best))
    for i in range(len(entries) - 1, -1, -1):
        if took[i, room]:
            size, take = entries[i]
            found[size] = found.get(size, 0) + take
            room -= size * take
    return found


def solve(counts: np.ndarray, capacity: int, iterations: int = ITERATIONS, rate: float = RATE) -> list[tuple[float, dict[int, int]]]:
    """Fractional configurations that cover ``counts`` (index = size), by multiplicative weights.

    A step takes the priced configuration as often as covers a share of its
    scarcest size, and lowers the weight of each size by
    ``exp(-rate * share of it that was covered)``.  At the end all amounts are
    scaled so that their volume is that of the histogram.
    """
    sizes = np.arange(len(counts))
    if not counts.any():
        return []
    weight = np.ones(len(counts))
    prior = (sizes / capacity) ** POWER
    chosen: dict[tuple, float] = {}
    for _ in range(iterations):
        # Value per copy: by size (space well filled) times weight (not yet covered).
        config = price(prior * weight / weight[counts > 0].max(), counts, capacity)
        amount = STEP * min(counts[n] / a for n, a in config.items())
        key = tuple(sorted(config.items(), reverse=True))
        chosen[key] = chosen.get(key, 0.0) + amount
        for n, a in config.items():
            weight[n] *= math.exp(-rate * a * amount / counts[n])
    scale = float(np.dot(sizes, counts)) / sum(x * sum(n * a for n, a in key) for key, x in chosen.items())
    # Fullest configurations first: they are the ones rounding should keep.
    return sorted(((x * scale, dict(key)) for key, x in chosen.items()), key=lambda p: (-sum(n * a for n, a in p[1].items()), -p[0], sorted(p[1].items())))


Group = tuple[int, tuple[tuple[int, int], ...]]  # (number of equal sequences, their content as (length, copies))


def best_fit(counts: np.ndarray, capacity: int, begun: list[Group]) -> list[Group]:
    """Best fit decreasing on a histogram, into the free space of ``begun`` sequences first."""
    open_: dict[int, list[Group]] = {}  # free space -> groups of equal sequences
    full: list[Group] = []
    free_sizes = np.zeros(capacity + 1, dtype=bool)

    def put(free: int, group: Group) -> None:
        if not group[0]:
            return
        if free == 0:
            full.append(group)
        else:
            open_.setdefault(free, []).append(group)
            free_sizes[free] = True

    for number, content in begun:
        put(capacity - sum(n * k for n, k in content), (number, content))
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = int(np.argmax(free_sizes[length:])) + length
            if not free_sizes[at]:
                fits = capacity // length
                many, rest = divmod(left, fits)
                put(capacity - fits * length, (many, ((length, fits),)))
                if rest:
                    put(capacity - rest * length, (1, ((length, rest),)))
                break
            number, content = open_[at].pop()
            if not open_[at]:
                free_sizes[at] = False
            fits = at // length
            use = min(number, left // fits)
            put(at - fits * length, (use, (*content, (length, fits))))
            left -= use * fits
            if use < number:
                if left:
                    put(at - left * length, (1, (*content, (length, left))))
                    put(at, (number - use - 1, content))
                    left = 0
                else:
                    put(at, (number - use, content))
    return full + [g for groups in open_.values() for g in groups]


def fill(times: int, config: dict[int, int], supply: dict[int, list[list[int]]]) -> Iterator[Group]:
    """Give the slots of a configuration of size classes real lengths, longest first, as groups of equal sequences."""
    slots = [c for c, copies in sorted(config.items(), reverse=True) for _ in range(copies)]
    runs: list[list[list[int]]] = []
    for c in slots:  # each slot takes ``times`` pieces of its class
        need, mine = times, []
        while need:
            take = min(need, supply[c][-1][1])
            mine.append([supply[c][-1][0], take])
            supply[c][-1][1] -= take
            need -= take
            if not supply[c][-1][1]:
                supply[c].pop()
        runs.append(mine[::-1])
    while times:
        same = min(r[-1][1] for r in runs)
        content: dict[int, int] = {}
        for r in runs:
            content[r[-1][0]] = content.get(r[-1][0], 0) + 1
            r[-1][1] -= same
            if not r[-1][1]:
                r.pop()
        times -= same
        yield same, tuple(sorted(content.items(), reverse=True))


def cover(left: np.ndarray, capacity: int, above: int, iterations: int, solves: int) -> list[Group]:
    """Whole configurations of pieces longer than ``above``; what they hold is taken out of ``left``.

    The program has classes of ``capacity / UNITS`` tokens, rounded up, which
    bounds its size.  It is solved and rounded down several times, each time on
    what the last rounding left.
    """
    step = max(1, capacity // UNITS)
    units = capacity // step
    supply: dict[int, list[list[int]]] = {}
    classes = np.zeros(units + 1, dtype=np.int64)
    for length in range(above + 1, capacity + 1):  # ascending, so the longest is taken first (from the end)
        c = -(-length // step)
        if left[length] and c <= units:
            supply.setdefault(c, []).append([length, int(left[length])])
            classes[c] += left[length]
    begun: list[Group] = []
    for _ in range(solves):
        before = int(classes.sum())
        for amount, config in solve(classes, units, iterations):
            times = min(round(amount), *(int(classes[c]) // a for c, a in config.items()))
            if times > 0:
                for c, a in config.items():
                    classes[c] -= times * a
                for group in fill(times, config, supply):
                    begun.append(group)
                    for length, k in group[1]:
                        left[length] -= group[0] * k
        if int(classes.sum()) in (0, before):
            break
    return begun


def plan(counts: np.ndarray, capacity: int, iterations: int = ITERATIONS, solves: int = SOLVES) -> list[Group]:
    """Whole configurations that hold every piece of the histogram exactly once: the fewest of up to three plans.

    The first has a program over the long pieces (above ``capacity / SMALL``);
    the rest goes to the free space by best fit.  Unless that is within ``GAP`` of the
    volume bound, the second solves the program again over the rest that exceeds the
    free space of the long pieces' sequences, and the third has one program over
    all lengths.  Pieces so short that rounding to classes would cost them more
    than a sixteenth stay with best fit, which they let fill any sequence.
    """
    sizes = np.arange(len(counts))
    sequences = lambda groups: sum(n for n, _ in groups)
    step = max(1, capacity // UNITS)
    least = 0 if step == 1 else 16 * step
    left = counts.astype(np.int64).copy()
    bound = -(-int(np.dot(sizes, left)) // capacity)
    begun = cover(left, capacity, capacity // SMALL, iterations, solves)
    plans = [best_fit(left, capacity, begun)]
    if sequences(plans[0]) > bound + max(1, int(GAP * bound)):
        spare = sum(n * (capacity - sum(x * k for x, k in content)) for n, content in begun)
        volume = int(np.dot(sizes, left))
        if volume - spare >= capacity:
            part = np.floor(left * ((volume - spare) / volume)).astype(np.int64)
            rest = left - part
            more = cover(part, capacity, least, iterations, solves)
            plans.append(best_fit(rest + part, capacity, begun + more))
        left = counts.astype(np.int64).copy()
        begun = cover(left, capacity, least, iterations, solves)
        plans.append(best_fit(left, capacity, begun))
    return min(plans, key=sequences)


class Slots:
    """The plan as sorted interval arrays, one lookup per (length, rank)."""

    def __init__(self, configs: list[Group], capacity: int) -> None:
        rows: list[tuple[int, int, int, int, int]] = []
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        sequence = 0
        for times, content in configs:
            offset = 0
            for length, copies in content:
                rows.append((length, int(ranks[length]), copies, sequence, offset))
                ranks[length] += times * copies
                offset += length * copies
            sequence += times
        rows.sort()
        self.n_sequences = sequence
        table = np.array(rows, dtype=np.int64).reshape(-1, 5)
        self.length, self.first, self.copies, self.sequence, self.offset = table.T.copy()
        self.begin = np.searchsorted(self.length, np.arange(capacity + 2))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), dtype=np.int64)
        for n in np.unique(length):
            mine = length == n
            lo, hi = self.begin[n], self.begin[n + 1]
            at[mine] = lo + np.searchsorted(self.first[lo:hi], rank[mine], side="right") - 1
        past = rank - self.first[at]
        return self.sequence[at] + past // self.copies[at], self.offset[at] + past % self.copies[at] * length


def pack(pieces: DataFrame, capacity: int = CAPACITY, iterations: int = ITERATIONS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    The pieces are written once to the shared folder, each with its task and
    its rank among the task's pieces of that length, so every later read, also
    after a lost executor, sees the same ranks.
    """
    spark = pieces.sparkSession
    where = pieces.columns.index("length")
    # Names of our own that no input column has.
    task_col, rank_col, n_col, before_col, slot_col = (free_name(n, pieces.columns) for n in ("_task", "_rank", "_n", "_before", "_slot"))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            length = batch.column(where).to_numpy(zero_copy_only=False)
            order = np.argsort(length, kind="stable")
            sizes = np.bincount(length, minlength=capacity + 1)
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            rank = np.empty(len(length), dtype=np.int64)
            rank[order] = np.arange(len(length)) - first[length[order]]
            rank += seen[length]
            seen += sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(length), pa.int32()), pa.array(rank)], names=[*batch.schema.names, task_col, rank_col]
            )

    schema = StructType([*pieces.schema.fields, StructField(task_col, IntegerType()), StructField(rank_col, LongType())])
    path = scratch_path(spark, "pieces")
    pieces.mapInArrow(ranked, schema).write.parquet(path)
    held = spark.read.schema(schema).parquet(path)
    counts = held.groupBy("length", task_col).agg(F.count(F.lit(1)).alias(n_col))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum(n_col).alias("n")).collect():
        histogram[r["length"]] = r["n"]
    slots = spark.sparkContext.broadcast(Slots(plan(histogram, capacity, iterations), capacity))
    before = Window.partitionBy("length").orderBy(task_col).rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("length", task_col, F.coalesce(F.sum(n_col).over(before), F.lit(0)).alias(before_col))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = slots.value.place(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    placed = held.join(earlier, ["length", task_col]).withColumn(slot_col, place(F.col("length"), F.col(rank_col) + F.col(before_col)))
    keep = [quoted(c) for c in pieces.columns if c not in ("sequence_id", "offset")]
    return placed.select(*keep, F.col(slot_col)["sequence_id"].alias("sequence_id"), F.col(slot_col)["offset"].alias("offset"))


def build_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` (uint32 bytes): the packed pieces' ids in order; a sequence has ``capacity`` tokens at most."""
    joined = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return joined.select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    capacity = options.get("capacity", CAPACITY)
    return pack(tokenize_pieces(docs, id_col, text_col, **options), capacity)


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
