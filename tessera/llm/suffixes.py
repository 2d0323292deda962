"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte is removed when a ``threshold``-byte string that covers it also starts in
a document with a smaller id.  To know that, suffixes need only be ordered
through their first ``threshold`` bytes: equal groups are exactly the repeated
windows.  The order is made by most-significant-digit passes, each of which
drops the groups that cannot repeat, so later digits are looked at only where
earlier ones were equal:

1. first digit: ``k`` bytes (about half the threshold).  Every window contains
   the smallest-hashed of its k-byte strings, and two equal windows contain it at
   the same place, so only these *anchors* need sorting (one position in
   fourteen at 50 bytes).  Anchors in a single document are dropped.
2. second digit: the anchor with all bytes that windows around it can cover.
   Where the whole surrounding equals that of a smaller document, all its
   windows repeat and nothing more is asked.
3. third digit: the full ``threshold`` bytes, for the windows around anchors whose
   group has several surroundings (the edges of repeated passages).

Digits are compared by digests (48 bits where they only filter, 80 bits where
they decide).  Documents are dealt to chunks; each chunk sends a digit's
distinct values with the smallest document that has them, packed by value
range, and gets an answer aligned with what it sent.  A passage held by a third
of all documents is thus one value per chunk, never a gathered group.  A group
with very many surroundings in one chunk sends ``MAX_SURROUNDINGS`` of them
through pass 2; the rest go to pass 3, which is exact for any number.

The text is shuffled once; all passes read that shuffle.  A chunk's text and
what is derived from it are in memory together: about ``CHUNK_BYTES``, or the
longest document.

Cases: a null or empty text has no bytes and stays as it is; a null id counts as
larger than any other; rows with the same id do not remove each other's bytes;
documents below the threshold are never cut; an empty table gives an empty
result; result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tessera.llm.common import free_name, give_back, mix64, quoted, read_table

THRESHOLD = 50
CHUNK_BYTES = 4 << 20
BLOCK = 1 << 17
BUCKET_ENTRIES = 500_000
MAX_SURROUNDINGS = 4
LAST = np.int64((1 << 63) - 1)
U = np.uint64
# Masks of a little-endian word's bytes from the k-th on, and of those before the k-th.
FROM = np.array([(1 << 64) - (1 << 8 * k) for k in range(9)], dtype=U)
UPTO = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)


# -- packing of integer columns ------------------------------------------------


def put(values: np.ndarray, sorted_: bool = False) -> bytes:
    """An integer column as bytes: differences if sorted, byte planes, zstandard."""
    v = values.astype(np.uint64)
    if sorted_ and len(v):
        v = np.concatenate((v[:1], np.diff(v)))
    return zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def get(blob: bytes, sorted_: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    v = np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64)
    return np.cumsum(v, dtype=np.uint64) if sorted_ else v


# -- one chunk -------------------------------------------------------------------


class Chunk:
    """The documents of one chunk as one byte string, with anchors found over it."""

    def __init__(self, ids: pa.Array, texts: pa.Array, threshold: int) -> None:
        self.threshold = threshold
        self.k = threshold // 2 - 1 if threshold >= 8 else max(1, threshold // 2)
        raw = texts.cast(pa.large_binary()).fill_null(b"")
        raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        self.ids = ids.cast(pa.int64()).fill_null(int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.fromiter((len(x.as_buffer()) for x in raw), dtype=np.int64, count=len(raw))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        # Zero bytes around the text, so words that begin before it or end after it can be read.
        self.front = threshold + 8
        padded = np.frombuffer(b"".join([bytes(self.front), *(x.as_py() for x in raw), bytes(2 * threshold + 16)]), dtype=np.uint8)
        self.buf = padded[self.front : self.front + int(sizes.sum())]
        self.eight = np.ndarray((len(padded) - 7,), dtype=U, buffer=padded, strides=(1,))

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        """Row of each position (rows without bytes hold none)."""
        return np.searchsorted(self.ends, at, side="right")

    def words(self, at: np.ndarray, doc: np.ndarray, before: int, after: int) -> Iterator[np.ndarray]:
        """The bytes [at - before, at + after) as columns of uint64 words, zero outside the documents ``doc``."""
        begin, end = self.starts[doc], np.minimum(self.ends[doc], at + after)
        for shift in range(-before, after, 8):
            first = at + shift
            word = self.eight[first + self.front]
            # A document begins at or before ``at`` and ends after it, so only words on that side are cut there.
            if shift < 0:
                word &= FROM[np.clip(begin - first, 0, 8)]
            if shift > -8:
                word &= UPTO[np.clip(end - first, 0, 8)]
            yield word

    def digest(self, at: np.ndarray, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
        """80-bit digests (64 and 16 bits) of the bytes around positions and of how far they reach."""
        first, second = np.empty(len(at), U), np.empty(len(at), U)
        for lo in range(0, len(at), 1 << 16):
            some = at[lo : lo + (1 << 16)]
            doc = self.doc_of(some)
            left = np.minimum(some - self.starts[doc], before).astype(U)
            right = np.minimum(self.ends[doc] - some, after).astype(U)
            a = mix64((left << U(32)) | right | U(1 << 62))
            b = mix64(a ^ U(0x2545F4914F6CDD1D))
            for column in self.words(some, doc, before, after):
                a *= U(0x9E3779B97F4A7C15)
                a += column
                a = mix64(a)
                b ^= column
                b *= U(0xD6E8FEB86659FD93)
                b = mix64(b)
            first[lo : lo + len(some)] = a
            second[lo : lo + len(some)] = b >> U(48)
        return first, second

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all anchors and their 48-bit digests, found block by block."""
        at: list[np.ndarray] = [np.empty(0, np.int64)]
        key: list[np.ndarray] = [np.empty(0, U)]
        margin = 2 * self.threshold
        for lo in range(0, len(self.buf), BLOCK):
            a, b = max(0, lo - margin), min(len(self.buf), lo + BLOCK + margin)
            found, hashes = self._anchors(a, b)
            mine = (found >= lo) & (found < lo + BLOCK)
            at.append(found[mine])
            key.append(hashes[mine] >> U(16))
        return np.concatenate(at), np.concatenate(key)

    def _anchors(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        t, k = self.threshold, self.k
        n = hi - lo
        if n < t:
            return np.empty(0, np.int64), np.empty(0, U)
        # This digest orders and filters only, so its words are mixed lightly; the last step spreads all bits.
        x = np.full(n - k + 1, 0x1234567, dtype=U)
        eight = self.eight[self.front + lo :]
        for j in range(0, k, 8):
            part = eight[j : j + len(x)]
            x ^= part & U((1 << (8 * (k - j))) - 1) if k - j < 8 else part
            x *= U(0x9E3779B97F4A7C15)
            x ^= x >> U(32)
        x = mix64(x)
        x |= U(1)
        w = t - k + 1
        small = slide(x, w, np.minimum)
        # A window counts only if it ends inside its document.
        end = lo + len(small)
        some = slice(int(self.doc_of(lo)), int(self.doc_of(end - 1)) + 1)
        held_by = np.minimum(self.ends[some], end) - np.maximum(self.starts[some], lo)
        small[np.arange(lo, end) > np.repeat(self.ends[some] - t, held_by)] = 0
        edge = np.zeros(w - 1, U)
        chosen = np.flatnonzero(slide(np.concatenate((edge, small, edge)), w, np.maximum) == x)
        return chosen + lo, x[chosen]

    def window_starts(self, at: np.ndarray) -> np.ndarray:
        """Mask over positions where a window that covers an anchor at ``at`` starts."""
        doc = self.doc_of(at)
        first = np.maximum(at - (self.threshold - self.k), self.starts[doc])
        last = np.minimum(at, self.ends[doc] - self.threshold)
        good = last >= first
        edge = np.zeros(len(self.buf) + 1, dtype=np.int32)
        np.add.at(edge, first[good], np.int32(1))
        np.add.at(edge, last[good] + 1, np.int32(-1))
        return np.cumsum(edge[:-1], dtype=np.int32) > 0


def slide(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over every run of ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def group_min(keys: list[np.ndarray], values: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest value of each, and each row's group."""
    order = np.argsort(keys[0])
    new = changes(keys[0][order])
    if len(keys) > 1:
        # The further keys seldom split a group of the first; if they do, all keys are sorted.
        every = new.copy()
        for key in keys[1:]:
            every |= changes(key[order])
        if (every != new).any():
            order = np.lexsort(tuple(reversed(keys)))
            new = changes(keys[0][order])
            for key in keys[1:]:
                new |= changes(key[order])
    begin = np.flatnonzero(new)
    first = order[begin]
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(values[order], begin) if len(begin) else values[:0]
    return [key[first] for key in keys], least, back


def changes(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it; the first one does."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return new


class State:
    """What a chunk knows after the answers so far; each step is repeated exactly by every later pass."""

    def __init__(self, ids: pa.Array, texts: pa.Array, threshold: int, buckets: int) -> None:
        self.c = Chunk(ids, texts, threshold)
        self.buckets = buckets
        self.at, self.key = self.c.anchors()
        self.doc = self.c.ids[self.c.doc_of(self.at)] if len(self.at) else np.empty(0, np.int64)

    def split(self, key: np.ndarray, bits: int) -> np.ndarray:
        """Boundaries of the buckets (equal value ranges) in a sorted key column."""
        top = (key >> U(bits - 32)) * U(self.buckets) >> U(32)
        return np.searchsorted(top, np.arange(self.buckets + 1, dtype=np.uint64))

    # pass 1
    def first(self) -> np.ndarray:
        self.order = np.argsort(self.key)
        inorder = self.key[self.order]
        self.new = changes(inorder)
        return inorder[self.new]

    def after_first(self, repeated: np.ndarray) -> None:
        """Keep the anchors that other chunks have too, or two documents here."""
        begin, doc = np.flatnonzero(self.new), self.doc[self.order]
        keep = np.zeros(len(doc), dtype=bool)
        if len(begin):
            several = np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
            keep[self.order] = (repeated | several)[np.cumsum(self.new) - 1]
        self.at, self.key, self.doc = self.at[keep], self.key[keep], self.doc[keep]
        del self.order, self.new

    # pass 2
    def second(self) -> tuple[np.ndarray, ...]:
        """Distinct (anchor, surrounding) with the smallest document: what is sent, in order."""
        t, k = self.c.threshold, self.c.k
        one, two = self.c.digest(self.at, t - k, t)
        (key, one, two), low, self.group = group_min([self.key, one, two], self.doc)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        place = np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        self.low, self.spare = low, place >= MAX_SURROUNDINGS
        # The spare surroundings of an anchor are one entry without digest (the greatest values sort it last).
        rest = np.flatnonzero(place == MAX_SURROUNDINGS)
        self.sent = np.flatnonzero(place <= MAX_SURROUNDINGS)
        one[rest], two[rest] = ~U(0), ~U(0)
        if len(rest):
            run = np.cumsum(new) - 1
            least = np.full(run[-1] + 1, LAST)
            np.minimum.at(least, run[self.spare], low[self.spare])
            low = low.copy()
            low[rest] = least[run[rest]]
        self.run = np.cumsum(new) - 1
        s = self.sent
        return key[s], one[s], two[s], low[s]

    def after_second(self, less: np.ndarray, contested: np.ndarray) -> None:
        """``less``: by how much the smallest document elsewhere is smaller; ``contested``: other surroundings exist."""
        low = self.low.copy()
        real = ~self.spare[self.sent]
        low[self.sent[real]] -= less[real].astype(np.int64)
        runs_contested = np.zeros(self.run[-1] + 1 if len(self.run) else 0, dtype=bool)
        runs_contested[self.run[self.sent[contested]]] = True
        full = self.doc > low[self.group]
        self.hit = self.c.window_starts(self.at[full])
        # Documents that are the smallest of their surrounding stand for it in pass 3.
        open_ = ~full & runs_contested[self.run[self.group]] if len(self.group) else full
        self.marked = np.flatnonzero(self.c.window_starts(self.at[open_]))

    # pass 3
    def third(self) -> tuple[np.ndarray, ...]:
        one, two = self.c.digest(self.marked, 0, self.c.threshold)
        self.window_doc = self.c.ids[self.c.doc_of(self.marked)] if len(self.marked) else np.empty(0, np.int64)
        (one, two), self.window_low, self.window_group = group_min([one, two], self.window_doc)
        return one, two, self.window_low

    def after_third(self, less: np.ndarray) -> None:
        low = self.window_low - less.astype(np.int64)
        self.hit[self.marked[self.window_doc > low[self.window_group]]] = True

    def spans(self) -> list[list[int]]:
        """Removed byte ranges per document: flat start, end, relative to the document."""
        t = self.c.threshold
        starts = np.flatnonzero(self.hit)
        out: list[list[int]] = [[] for _ in self.c.ids]
        if not len(starts):
            return out
        cut = np.flatnonzero((np.diff(starts) > t) | (np.diff(self.c.doc_of(starts)) > 0))
        begin = starts[np.concatenate(([0], cut + 1))]
        end = starts[np.concatenate((cut, [len(starts) - 1]))] + t
        doc = self.c.doc_of(begin)
        for d, b, e in zip(doc.tolist(), (begin - self.c.starts[doc]).tolist(), (end - self.c.starts[doc]).tolist(), strict=True):
            out[d] += [b, e]
        return out


# -- passes over the chunks ---------------------------------------------------------

SENT = "bucket int, chunk int, step int, a binary, b binary, c binary, d binary"
SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("step", pa.int32())] + [(n, pa.binary()) for n in "abcd"])
ANSWER = "chunk int, bucket int, step int, a binary, b binary"
ANSWER_ARROW = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("step", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def send(state: State, step: int, chunk: int, columns: tuple[np.ndarray, ...], bits: int) -> pa.Table:
    """A chunk's entries, cut by value range of the first column."""
    bounds = state.split(columns[0], bits)
    rows = []
    for b in range(state.buckets):
        lo, hi = bounds[b], bounds[b + 1]
        if lo < hi:
            parts = [put(col[lo:hi], sorted_=j == 0) for j, col in enumerate(columns)]
            rows.append((b, chunk, step, *parts, *[None] * (4 - len(parts))))
    return _table(rows, SENT_ARROW)


def answer(table: pa.Table) -> pa.Table:
    """One value range of one pass: all chunks' entries sorted by digit; answers aligned with each chunk's entries."""
    rows = table.to_pylist()
    step, bucket = rows[0]["step"], rows[0]["bucket"]
    columns = [np.concatenate([get(r[n], n == "a") for r in rows]) for n in "abcd" if rows[0][n] is not None]
    sizes = [len(get(r["a"], True)) for r in rows]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    if step == 1:
        order = np.argsort(columns[0])
        new = changes(columns[0][order])
        first, second = np.empty(len(order), dtype=bool), None
        first[order] = ~(new & np.append(new[1:], True))
    else:
        *keys, low = columns
        low = low.astype(np.int64)
        distinct, least, back = group_min(keys, low)
        first = (low - least[back]).astype(np.uint64)
        second = None
        if step == 2:
            # Spare entries (greatest digest) stand for several surroundings each.
            spare = distinct[1] == ~U(0)
            new = np.ones(len(least), dtype=bool)
            new[1:] = distinct[0][1:] != distinct[0][:-1]
            run = np.cumsum(new) - 1
            small = np.full(run[-1] + 1, LAST)
            great = np.full(run[-1] + 1, -LAST)
            np.minimum.at(small, run, least)
            np.maximum.at(great, run, least)
            contested = small < great
            contested[run[spare]] = True
            second = contested[run[back]]
            first[spare[back]] = 0
    out = []
    for r, lo, hi in zip(rows, bounds[:-1], bounds[1:], strict=True):
        a = put(first[lo:hi])
        out.append((r["chunk"], bucket, step, a, None if second is None else put(second[lo:hi])))
    return _table(out, ANSWER_ARROW)


def answered(answers: pa.Table, step: int, column: str) -> np.ndarray:
    """A pass's answers of one chunk in the order of its entries."""
    rows = sorted((r["bucket"], r[column]) for r in answers.to_pylist() if r["step"] == step)
    return np.concatenate([get(blob) for _, blob in rows] or [np.empty(0, U)])


def replay(state: State, answers: pa.Table, upto: int) -> State:
    """Bring a chunk to the state after ``upto`` answered passes."""
    for step in range(1, upto + 1):
        if step == 1:
            state.first()
            state.after_first(answered(answers, 1, "a").astype(bool))
        elif step == 2:
            state.second()
            state.after_second(answered(answers, 2, "a"), answered(answers, 2, "b").astype(bool))
        else:
            state.third()
            state.after_third(answered(answers, 3, "a"))
    return state


def _partitions(spark: SparkSession, chunks: int) -> int:
    # Hash collisions of chunks even out at a few chunks per partition; never below the session's
    # own shuffle parallelism, so the grouping below reuses this one text shuffle.
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chunks // 3))


def find_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Add ``repeat_spans``: flat (start, end, ...) byte ranges to remove, to every row.  Ids must be integers."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(quoted(text_col))).alias("n")).collect()[0]["n"] or 0
    chunks = max(1, -(-size // chunk_bytes))
    buckets = max(1, -(-size * 2 // (threshold // 2) // BUCKET_ENTRIES))
    names = [c for c in docs.columns if c != "repeat_spans"]
    chunk_col = free_name("_chunk", names)
    id_at, text_at = names.index(id_col), names.index(text_col)
    chunk = F.pmod(F.xxhash64(quoted(id_col), quoted(text_col)), F.lit(chunks)).cast("int")
    dealt = docs.select(*[quoted(c) for c in names], chunk.alias(chunk_col)).repartition(_partitions(spark, chunks), chunk_col)

    def state_of(table: pa.Table) -> State:
        return State(table.column(id_at), table.column(text_at), threshold, buckets)

    def send_first(table: pa.Table) -> pa.Table:
        state = state_of(table)
        out = send(state, 1, table.column(len(names))[0].as_py(), (state.first(),), 48)
        del state
        give_back()
        return out

    def send_later(step: int):
        def run(left: pa.Table, answers: pa.Table) -> pa.Table:
            if not left.num_rows:
                return SENT_ARROW.empty_table()
            state = replay(state_of(left), answers, step - 1)
            entries = state.second() if step == 2 else state.third()
            out = send(state, step, left.column(len(names))[0].as_py(), entries, 48 if step == 2 else 64)
            del state, entries
            give_back()
            return out

        return run

    def finish(left: pa.Table, answers: pa.Table) -> pa.Table:
        spans = replay(state_of(left), answers, 3).spans() if left.num_rows else []
        give_back()
        return left.drop_columns([chunk_col]).append_column("repeat_spans", pa.array(spans, pa.list_(pa.int64())))

    def reply(sent: DataFrame) -> DataFrame:
        return sent.groupBy("bucket").applyInArrow(answer, ANSWER)

    def with_answers(func, answers: DataFrame, schema) -> DataFrame:
        return dealt.groupBy(chunk_col).cogroup(answers.groupBy("chunk")).applyInArrow(func, schema)

    one = reply(dealt.groupBy(chunk_col).applyInArrow(send_first, SENT))
    two = one.unionByName(reply(with_answers(send_later(2), one, SENT)))
    three = two.unionByName(reply(with_answers(send_later(3), two, SENT)))
    schema = StructType([*docs.select(*[quoted(c) for c in names]).schema.fields, StructField("repeat_spans", ArrayType(LongType()))])
    return with_answers(finish, three, schema)


def cut_bytes(text: bytes, spans: list[int]) -> bytes:
    out, at = [], 0
    for s, e in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[at:s])
        at = e
    return b"".join([*out, text[at:]])


def whole_characters(text: bytes, spans: list[int]) -> list[int]:
    """The spans without characters that they cover in part."""
    out: list[int] = []
    for s, e in zip(spans[::2], spans[1::2], strict=True):
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out += [s, e]
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, **options) -> DataFrame:
    """The documents without their repeated spans (whole characters only); ``n_chars``, where present, follows the text."""
    kind = dict(docs.dtypes)
    # The other columns travel as one struct, so none of them clashes with those added here.
    row = F.struct(*[quoted(c) for c in docs.columns if c != text_col])
    found = find_repeats(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), row.alias("row")), "id", "text", threshold, **options)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts.cast(pa.large_binary()), spans, strict=True):
            raw = t.as_py()
            out.append(None if raw is None else cut_bytes(raw, whole_characters(raw, s.as_py() or [])))
        return pa.array(out, pa.binary()).cast(pa.string())

    changed = F.size("repeat_spans") > 0
    new = F.when(changed, cut(F.col("text"), F.col("repeat_spans"))).otherwise(F.col("text"))
    out = found.withColumn("cut", new)
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("cut").alias(c))
        elif c == "n_chars":
            cols.append(F.when(changed, F.length("cut").cast(kind[c])).otherwise(F.col("row").getField(c)).alias(c))
        else:
            cols.append(F.col("row").getField(c).alias(c))
    return out.select(*cols)


def q_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).cast(pa.large_binary()), batch.column(2), strict=True):
                raw, cut = text.as_py() or b"", spans.as_py()
                removed = sum(cut[1::2]) - sum(cut[::2])
                rows.append((len(raw), removed, len(cut) // 2, hashlib.sha256(cut_bytes(raw, cut)).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return found.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (
  SELECT doc_id, x, unnest(range(0, greatest(0, CAST(length(x) // 2 AS BIGINT) - 49))) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.i FROM w JOIN m USING (s) WHERE w.doc_id > m.first_id),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hit)),
r AS (SELECT doc_id, run, min(i) AS b, max(i) + 50 AS e FROM g GROUP BY doc_id, run),
k AS (SELECT r.doc_id, count(*) AS n_spans, sum(e - b) AS n_removed,
  list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es FROM r GROUP BY r.doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE array_to_string(list_transform(range(0, n_spans + 1), lambda j:
    substr(x, 2 * (CASE WHEN j = 0 THEN 0 ELSE es[j] END) + 1,
      2 * ((CASE WHEN j = n_spans THEN CAST(length(x) // 2 AS BIGINT) ELSE bs[j + 1] END) - (CASE WHEN j = 0 THEN 0 ELSE es[j] END)))), '') END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
