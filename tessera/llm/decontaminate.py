"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items form one generalised suffix
automaton over word ids.  A document is streamed through it word by word; the
automaton gives, for each position, the longest suffix of the words read that
occurs in some item.  A position whose match reaches ``window`` words closes an
occurrence of a window; an item shorter than ``window`` is one window and is
found through a precomputed chain of the states that are whole short items.

A document word inside any occurrence of a window is *hit*.  ``decontaminate``
removes hit runs of at least ``min_span`` words from the text and drops
documents whose hit share exceeds ``max_coverage``.

The automaton holds at most two states per benchmark word.  Items are read in
blocks of at most ``max_block_words`` words, each with an automaton of its own,
so what is broadcast is bounded whatever the benchmark's size; a document's
hits are the union over the blocks.

Cases: a null or empty text has no words; items without words are ignored; the windows
of an item with a null id are hit like any other's, but name no item; repeated items and repeated ids
count once; an empty benchmark hits nothing; repeated documents get equal rows;
result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from tessera.llm.common import free_name, quoted, read_table, runs, with_text_columns

WINDOW = 10
MAX_BLOCK_WORDS = 500_000

# Bytes outside 0-9, A-Z, a-z and UTF-8 multi-byte sequences end a word; A-Z is lowered.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x20]+")


def normalised_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Automaton:
    """Generalised suffix automaton over word ids (plain lists: it is walked one word at a time)."""

    window: int
    vocab: dict[bytes, int] = field(default_factory=dict)
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    #: Items that end in a state; after ``finish`` those of its whole subtree (where the state's words occur).
    items: list[set[str]] = field(default_factory=lambda: [set()])
    #: (length, items) of whole short items that are suffixes of the state's longest string.
    short: list[tuple[tuple[int, frozenset[str]], ...]] = field(default_factory=list)
    shortest: int = 0
    _short_items: list[tuple[list[int], str]] = field(default_factory=list)

    def _new(self, size: int, link: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.size.append(size)
        self.items.append(set())
        return len(self.next) - 1

    def _extend(self, last: int, c: int) -> int:
        """The state of the current item's prefix after one more word."""
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.size[q] == self.size[last] + 1 else self._split(last, c, q)
        cur = self._new(self.size[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._new(self.size[p] + 1, self.link[q], dict(self.next[q]))
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, item: str | None, words: list[bytes]) -> None:
        ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
        last = 0
        for c in ids:
            last = self._extend(last, c)
            if item is not None:
                self.items[last].add(item)
        self.shortest = min(self.shortest or self.window, len(ids), self.window)
        if len(ids) < self.window:
            self._short_items.append((ids, item))

    def finish(self) -> Automaton:
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True)
        whole: dict[int, tuple[int, set[str]]] = {}
        for ids, item in self._short_items:
            s = 0
            for c in ids:
                s = self.next[s][c]
            # The state may hold longer strings too; the length tells the item apart.
            named = whole.setdefault(s, (len(ids), set()))[1]
            if item is not None:
                named.add(item)
        for s in order:
            # Only windows of full length ask for a state's items: shorter states need no sets.
            if self.size[s] >= self.window and self.size[self.link[s]] >= self.window:
                self.items[self.link[s]] |= self.items[s]
        own = {s: (n, frozenset(x)) for s, (n, x) in whole.items()}
        self.short = [()] * len(self.size)
        for s in reversed(order):
            found = list(self.short[self.link[s]])
            if s in own:
                found.append(own[s])
            self.short[s] = tuple(found)
        return self

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Mask of hit words, and the items with an occurring window."""
        n = len(words)
        hit = np.zeros(n + 1, dtype=np.int32)
        met: set[int] = set()
        met_short: set[frozenset[str]] = set()
        if not self.shortest or n < self.shortest:
            return hit[:n].astype(bool), set()
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=n)
        nxt, link, size, window, short = self.next, self.link, self.size, self.window, self.short
        for a, b in runs(ids >= 0):
            if b - a < self.shortest:
                continue
            s = length = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while s and c not in nxt[s]:
                    s = link[s]
                    length = size[s]
                t = nxt[s].get(c)
                if t is None:
                    continue
                s, length = t, length + 1
                if length >= window:
                    hit[i + 1 - length] += 1
                    hit[i + 1] -= 1
                    w = s
                    while size[link[w]] >= window:
                        w = link[w]
                    met.add(w)
                for k, names in short[s]:
                    if k <= length:
                        hit[i + 1 - k] += 1
                        hit[i + 1] -= 1
                        met_short.add(names)
        # States repeat along a text: each one's items are joined in once.
        return np.cumsum(hit[:n]) > 0, set().union(*(self.items[w] for w in met), *met_short)


def automata(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_block_words: int) -> Iterator[Automaton]:
    """One automaton per block of items; items are streamed to the driver, one block held at a time."""
    auto, held = Automaton(window), 0
    rows = benchmark.select(quoted(id_col).cast("string").alias("i"), quoted(text_col).alias("t")).where("t IS NOT NULL")
    for row in rows.distinct().toLocalIterator():
        words = normalised_words(row["t"].encode())
        if not words:
            continue
        if held and held + len(words) > max_block_words:
            yield auto.finish()
            auto, held = Automaton(window), 0
        auto.add(row["i"], words)
        held += len(words)
    yield auto.finish()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_block_words: int = MAX_BLOCK_WORDS,
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (flat word ranges start, end, ...) and ``hit_items`` (sorted ids) to every row."""
    spark = docs.sparkSession
    out = docs
    for k, auto in enumerate(automata(benchmark, item_id_col, item_text_col, window, max_block_words)):
        shared = spark.sparkContext.broadcast(auto)

        def rows(texts: Iterator[bytes | None], shared=shared) -> Iterator[tuple]:
            a = shared.value
            for text in texts:
                words = normalised_words(text or b"")
                mask, items = a.scan(words)
                yield len(words), runs(mask).ravel().tolist(), sorted(items)

        names = ("n_words", "hit_spans", "hit_items") if k == 0 else ("n_words", free_name("hit_spans_", docs.columns), free_name("hit_items_", docs.columns))
        out = with_text_columns(out, text_col, StructType.fromDDL(f"{names[0]} long, {names[1]} array<long>, {names[2]} array<string>"), rows)
        if k:
            spans, items = F.col(names[1]), F.col(names[2])
            out = (
                out.withColumn("hit_spans", merge_spans(F.col("hit_spans"), spans))
                .withColumn("hit_items", F.array_sort(F.array_union("hit_items", items)))
                .drop(names[1], names[2])
            )
    found = ("n_words", "hit_spans", "hit_items")
    return out.select(*[quoted(c) for c in docs.columns if c not in found], *found)


@F.arrow_udf(ArrayType(LongType()))
def merge_spans(a, b):
    """Union of two lists of flat (start, end) ranges."""
    import pyarrow as pa

    out = []
    for x, y in zip(a, b, strict=True):
        flat = np.array((x.as_py() or []) + (y.as_py() or []), dtype=np.int64).reshape(-1, 2)
        merged: list[list[int]] = []
        for s, e in sorted(flat.tolist()):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out.append([v for r in merged for v in r])
    return pa.array(out, type=pa.list_(pa.int64()))


def cut_words(text: bytes, spans: list[int], min_span: int) -> bytes:
    """The text without the bytes from the first to the last word of each long enough span."""
    wanted = [(s, e) for s, e in zip(spans[::2], spans[1::2], strict=True) if e - s >= min_span]
    if not wanted:
        return text
    places = [m.span() for m in _WORD.finditer(text.translate(_TABLE))]
    out, at = [], 0
    for s, e in wanted:
        out.append(text[at : places[s][0]])
        at = places[e - 1][1]
    out.append(text[at:])
    return b"".join(out)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    max_coverage: float = 0.5,
    min_span: int = 1,
    window: int = WINDOW,
    **options,
) -> DataFrame:
    """Drop documents whose hit share exceeds ``max_coverage``; cut hit spans of ``min_span`` words or more from the rest.

    The columns are those of ``docs``; ``n_chars``, where present, follows the new text.
    """
    import pyarrow as pa

    found = "_spans"
    while found in docs.columns:
        found += "_"

    @F.arrow_udf("string")
    def cut(texts, spans):
        raw = texts.cast(pa.large_binary())
        done = [None if t.as_py() is None else cut_words(t.as_py(), s.as_py() or [], min_span) for t, s in zip(raw, spans, strict=True)]
        return pa.array(done, type=pa.binary()).cast(pa.string())

    marked = find_contamination(
        docs.select(quoted(text_col).alias("_text"), F.struct(*[quoted(c) for c in docs.columns]).alias("_row")), benchmark, "_text", window=window, **options
    )
    span_words = F.aggregate(
        F.transform(F.col("hit_spans"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    kept = marked.where(span_words <= F.lit(max_coverage) * F.col("n_words"))
    kept = kept.withColumn(found, F.when(F.size("hit_spans") > 0, cut("_text", "hit_spans")).otherwise(F.col("_text")))
    cols = []
    for c in docs.columns:
        old = F.col("_row").getField(c)
        if c == text_col:
            cols.append(F.col(found).alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.size("hit_spans") > 0, F.length(found).cast(dict(docs.dtypes)[c])).otherwise(old).alias(c))
        else:
            cols.append(old.alias(c))
    return kept.select(*cols)


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    hits = F.aggregate(
        F.transform("hit_spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


#: DuckDB: windows of ten item words (or the whole shorter item) joined with the documents' words.
SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, w, least(10, len(w)) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
    SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM iw)),
ks AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k),
occ AS (SELECT p.doc_id, p.i, p.k, win.item_id FROM pos p JOIN win ON win.k = p.k AND win.g = array_to_string(p.w[p.i:p.i + p.k - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM occ)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN its t USING (doc_id)
"""
