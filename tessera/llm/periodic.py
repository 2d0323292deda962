"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of words with smallest period q (words q apart are equal), of
length at least max(``MIN_LENGTH``, 2 q), that no neighbouring word extends keeping q.

* **Sieve**: in a run of that length six neighbouring words or more recur q words later
  (``MIN_LENGTH`` 12), so a text in which no such window recurs has none.
* **Re-Pair**: the word ids of any other text are compressed, the most frequent pair of
  neighbouring symbols becoming a new nonterminal until no pair occurs twice.  The
  sequence that is left is halved into nonterminals that occur once, so every rule has
  two sides.
* **Runs of a nonterminal**: the runs inside its words that touch both sides of its
  boundary are computed once, at its first place in the text, for all periods and all
  nonterminals together: how far words q apart agree forward and backward of the boundary
  comes from ranks of power-of-two blocks.  Of equal stretches the smallest period holds.
* **Places**: a nonterminal's runs are moved to every place it derives.  Every run of the
  text is whole at the lowest node that holds it, and elsewhere shows as a piece of it
  with the same period, so the intervals not contained in another one of their period
  are the maximal ones.

Each text is work of its own: there is no shuffle and no broadcast.  Memory is that of a
batch and, for the longest text of n words, its ranks (4 n log n bytes) plus ``PAIRS``
(boundary, period) pairs at a time.

Cases: a null or empty text has no words, no runs and the digests of empty strings;
repeated rows give repeated results; a very long text is processed whole; an empty table
gives an empty result; result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm.common import quoted, read_table, window_codes, with_text_columns, word_ids

MIN_LENGTH = 12
PAIRS = 1 << 20


def recurs(ids: np.ndarray, length: int) -> bool:
    """Does any window of ``length`` ids occur twice?"""
    if len(ids) <= length:
        return False
    codes = np.sort(window_codes(ids, length))
    return bool((codes[1:] == codes[:-1]).any())


def re_pair(ids: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """Rules and the sequence left: rule r stands for symbol ``alphabet + r``, its sides are older symbols."""
    n, alphabet = len(ids), int(ids.max()) + 1
    symbol = ids.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # Places of the pairs that occur more than once; later pairs all hold a new symbol.
    codes = ids[:-1] * alphabet + ids[1:]
    order = np.argsort(codes, kind="stable")
    cut = np.flatnonzero(np.diff(codes[order])) + 1
    first, size = np.concatenate(([0], cut)), np.diff(np.concatenate(([0], cut, [n - 1])))
    places: dict[tuple[int, int], list[int]] = {}
    for a, m in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        at = order[a : a + m].tolist()
        places[symbol[at[0]], symbol[at[0] + 1]] = at
    heap = [(-len(at), pair) for pair, at in places.items()]
    heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heappop(heap)
        left, right = pair
        live, free = [], -1
        for i in places.pop(pair):
            j = after[i] if symbol[i] == left else n
            if i >= free and j < n and symbol[j] == right:
                live.append(i)
                free = j + 1
        if len(live) < 2:
            continue
        if heap and len(live) < -heap[0][0]:  # others are more frequent by now
            places[pair] = live
            heappush(heap, (-len(live), pair))
            continue
        new = alphabet + len(rules)
        rules.append(pair)
        for i in live:
            j = after[i]
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
        fresh: dict[tuple[int, int], list[int]] = {}
        for i in live:
            h, k = before[i], after[i]
            if h >= 0 and symbol[h] != new:
                fresh.setdefault((symbol[h], new), []).append(h)
            if k < n:
                fresh.setdefault((new, symbol[k]), []).append(i)
        for p, at in fresh.items():
            if len(at) > 1:
                places[p] = at
                heappush(heap, (-len(at), p))
    return rules, [s for s in symbol if s >= 0]


def halved(rules: list[tuple[int, int]], sequence: list[int], alphabet: int) -> list[tuple[int, int]]:
    """The rules with further ones that halve the sequence: the last rule derives the whole text."""
    rules = list(rules)
    while len(sequence) > 1:
        pairs = list(zip(sequence[::2], sequence[1::2], strict=False))
        fresh = [alphabet + len(rules) + i for i in range(len(pairs))]
        rules += pairs
        sequence = fresh + sequence[2 * len(pairs) :]
    return rules


class Blocks:
    """Ranks of all blocks of 1, 2, 4, ... ids; equal ranks mean equal blocks."""

    def __init__(self, ids: np.ndarray):
        self.n, self.ranks = len(ids), [ids.astype(np.int32)]
        while 2 << (len(self.ranks) - 1) <= self.n:
            last, half = self.ranks[-1], 1 << (len(self.ranks) - 1)
            code = (last[:-half].astype(np.int64) << 32) | last[half:]
            self.ranks.append(np.unique(code, return_inverse=True)[1].astype(np.int32))

    def near(self, i: np.ndarray, j: np.ndarray, start: np.ndarray, end: np.ndarray, level: int) -> np.ndarray:
        """Do the blocks of 2**level ids from i and j on agree, or those before them (inside [start, end))?"""
        level = min(level, len(self.ranks) - 1)
        rank, size = self.ranks[level], 1 << level
        out = np.zeros(len(i), dtype=bool)
        at = np.flatnonzero(j + size <= end)
        out[at] = rank[i[at]] == rank[j[at]]
        at = np.flatnonzero(~out & (i - size >= start))
        out[at] = rank[i[at] - size] == rank[j[at] - size]
        return out

    def forward(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many ids from i on equal those from j on (i < j), at most ``limit``."""
        out = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, size = self.ranks[level], 1 << level
            at = np.flatnonzero(out + size <= limit)
            if len(at):
                out[at[rank[i[at] + out[at]] == rank[j[at] + out[at]]]] += size
        return out

    def backward(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many ids before i equal those before j, at most ``limit``."""
        out = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, size = self.ranks[level], 1 << level
            at = np.flatnonzero(out + size <= limit)
            if len(at):
                out[at[rank[i[at] - out[at] - size] == rank[j[at] - out[at] - size]]] += size
        return out


def boundary_runs(blocks: Blocks, start: np.ndarray, cut: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the stretches of length max(least, 2 q) or more that cross ``cut`` inside [start, end).

    Positions are those of the node's first place.  Of equal stretches of a node only the smallest period is kept.
    """
    found = []
    # Ids q apart agree on half of ``least`` places or more, so on half of that on one side of any place among them.
    level = (-(-least // 4)).bit_length() - 1
    for right in (True, False):
        # A run has a whole period on one side of the boundary; q runs up to that side's length.
        room = np.minimum(end - cut if right else cut - start, (end - start) // 2)
        top = np.concatenate(([0], np.cumsum(room)))
        for lo in range(0, int(top[-1]), PAIRS):
            at = np.arange(lo, min(lo + PAIRS, int(top[-1])))
            node = np.searchsorted(top, at, side="right") - 1
            q = at - top[node] + 1
            i = cut[node] if right else cut[node] - q  # compare ids from i on with those from i + q on
            ok = blocks.near(i, i + q, start[node], end[node], level)
            node, q, i = node[ok], q[ok], i[ok]
            ahead = blocks.forward(i, i + q, end[node] - i - q)
            back = blocks.backward(i, i + q, i - start[node])
            size = ahead + back + q
            ok = (ahead + back >= q) & (size >= least)
            found.append(np.stack((node, i - back, i + q + ahead, q))[:, ok])
    node, s, e, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, e, s, node))
    node, s, e, q = node[order], s[order], e[order], q[order]
    new = np.ones(len(node), dtype=bool)
    new[1:] = (node[1:] != node[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return node[new], s[new], e[new], q[new]


def find_runs(ids: np.ndarray, least: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs of an id sequence, by start, then period."""
    none = np.empty((0, 3), dtype=np.int64)
    # Ids q apart agree on length - q >= max(q, least - q) places: at least half of ``least``.
    window = -(-least // 2)
    if not recurs(ids, window):
        return none
    alphabet = int(ids.max()) + 1
    rules, sequence = re_pair(ids)
    rules = halved(rules, sequence, alphabet)
    m = len(rules)
    left, right = np.array(rules, dtype=np.int64).T
    size = np.ones(alphabet + m, dtype=np.int64)
    for r, (a, b) in enumerate(rules):
        size[alphabet + r] = size[a] + size[b]
    # Places of every nonterminal: the last rule stands at 0, sides follow from their parents.
    places: list[list[int]] = [[] for _ in range(m)]
    places[-1] = [0]
    sizes = size.tolist()
    for r in range(m - 1, -1, -1):
        a, b = rules[r]
        if a >= alphabet:
            places[a - alphabet] += places[r]
        if b >= alphabet:
            step = sizes[a]
            places[b - alphabet] += [p + step for p in places[r]]
    first = np.array([min(p) for p in places], dtype=np.int64)
    long = np.flatnonzero(size[alphabet:] >= least)
    if not len(long):
        return none
    start = first[long]
    node, s, e, q = boundary_runs(Blocks(ids), start, start + size[left[long]], start + size[alphabet + long], least)
    spans = [none]
    for k, a, b, p in zip(node.tolist(), s.tolist(), e.tolist(), q.tolist(), strict=True):
        r = int(long[k])
        at = np.array(places[r], dtype=np.int64) + (a - int(first[r]))
        spans.append(np.stack((at, at + (b - a), np.full(len(at), p)), axis=1))
    span = np.concatenate(spans)
    span = span[np.lexsort((-span[:, 1], span[:, 0], span[:, 2]))]
    # Within a period, sorted by start and then longest first, a piece ends no later than one before it.
    key = span[:, 2] * (len(ids) + 1) + span[:, 1]
    top = np.maximum.accumulate(key)
    whole = np.ones(len(span), dtype=bool)
    whole[1:] = key[1:] > top[:-1]
    span = span[whole]
    span = span[np.lexsort((span[:, 2], span[:, 0]))]
    return np.stack((span[:, 0], span[:, 1] - span[:, 0], span[:, 2]), axis=1)


RESULT = StructType(
    [StructField(n, LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")]
    + [StructField(n, StringType()) for n in ("runs_sha256", "collapsed_sha256", "collapsed")]
)


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside repeats: of each run only the first period stays."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def describe(words: list[bytes], least: int) -> tuple:
    """The result columns for one text."""
    runs = find_runs(word_ids(words), least)
    text = collapse(words, runs)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
    top = (None, None, None, None)
    if len(runs):
        s, n, p = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        top = (s, n, p, 1000 * n // p)
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), text.decode())


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with, per text: ``n_runs``; ``start, length, period, exponent_milli`` of the longest run (ties: smallest
    start, then period); digests of the list of runs and of the collapsed text; and ``collapsed``, the text itself with
    every run cut to its first period (words joined by one space)."""

    def rows(texts: Iterator[bytes | None]) -> Iterator[tuple]:
        for text in texts:
            yield describe((text or b"").split(), least)

    return with_text_columns(docs, text_col, RESULT, rows)


def repeated_tail(words: list[bytes], h: int) -> list[bytes]:
    """Words from a on repeat with period p, both derived from the hash h of the id (no change unless h % 10 = 0)."""
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts with a periodic tail for every tenth id by hash (a null id has none); words are joined by one space."""

    def change(ids: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, t in zip(ids.to_pylist(), texts.cast(pa.large_binary()), strict=True):
            raw = t.as_py()
            out.append(raw if raw is None or h is None or h % 10 else b" ".join(repeated_tail(raw.split(), h)))
        return pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())

    changed = F.arrow_udf(change, "string")
    return docs.withColumn(text_col, changed(F.crc32(quoted(id_col).cast("string").cast("binary")), quoted(text_col).cast("string")))


def q_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs(docs).drop("text", "collapsed")


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS h FROM documents),
g AS (SELECT *, h // 10 AS g, len(w) AS m, CASE WHEN doc_id IS NOT NULL AND h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
t AS MATERIALIZED (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(m), lambda i: CASE WHEN i < a THEN w[i + 1]
  ELSE w[a + (i - a) % (1 + (m - a) // (3 + g % 8)) + 1] END) END AS w FROM g),
s AS MATERIALIZED (SELECT n, unnest(range(len(w) - 5)) AS i, unnest(list_transform(range(len(w) - 5), lambda j: array_to_string(w[j + 1 : j + 6], ' '))) AS k
  FROM t WHERE len(w) > 6),
p AS (SELECT n, x.i, y.i - x.i AS q FROM s x JOIN s y USING (n, k) WHERE x.i < y.i),
r AS (SELECT n, q, min(i) AS start, count(*) + 5 + q AS length FROM (SELECT n, q, i, i - row_number() OVER (PARTITION BY n, q ORDER BY i) AS island FROM p)
  GROUP BY n, q, island HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12),
f AS MATERIALIZED (SELECT n, start, length, min(q) AS period FROM r GROUP BY n, start, length),
l AS (SELECT n, count(*) AS n_runs, min(struct_pack(l := -length, s := start, p := period)) AS top,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM f GROUP BY n),
x AS (SELECT DISTINCT n, unnest(range(start + period, start + length)) AS i FROM f),
y AS (SELECT n, i FROM (SELECT n, unnest(range(len(w))) AS i FROM t SEMI JOIN f USING (n)) ANTI JOIN x USING (n, i)),
c AS (SELECT n, list(i ORDER BY i) AS stay FROM y GROUP BY n)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, -top.l AS length, top.p AS period, (-1000 * top.l) // top.p AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN stay IS NULL THEN w ELSE list_transform(stay, lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM t LEFT JOIN l USING (n) LEFT JOIN c USING (n)
"""
