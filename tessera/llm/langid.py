"""Language identification by rank-order profiles.

The most frequent 1- to 3-grams of a language, in order of frequency, are its
profile.  A document's own most frequent n-grams are compared with each profile
by the out-of-place distance: the sum, over the document's n-grams, of the
difference between the two ranks, or the profile size for an n-gram the profile
lacks.  The nearest profile wins; ties go to the smaller language name.

N-grams are taken from lower-cased letters; everything else is a word boundary
(one space).  An n-gram of up to three code points packs into one int64, so
counting is sorting integers.

Learning counts n-grams of all given rows: per-text counts are merged within a
task, summed by Spark per (language, n-gram), and the top ranks per language
(languages x ``size`` rows, whatever the corpus size) go to the driver and out
to the tasks.

Cases: a null text or one without a letter is ``und`` with score 0, as is every
text when there is nothing to learn from; rows with a null language are not
learned from; very long texts are counted in pieces of ``PIECE`` code points;
repeated rows count as often as they occur; result columns replace input
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import quoted, read_table, with_text_columns

PROFILE_SIZE = 300
PIECE = 1 << 20
SPACE = 32


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams_of(text: str, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of a text (sorted) and their counts."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    text = text.lower()
    # The last two symbols of a piece are carried over, so pieces count as one text.
    carried = np.array([SPACE], dtype=np.int64)
    for at in range(0, len(text), piece):
        x = np.frombuffer(text[at : at + piece].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        x = np.where(_letters()[x], x, SPACE)
        x = np.concatenate((carried, x, [SPACE] if at + piece >= len(text) else []))
        keep = np.ones(len(x), dtype=bool)
        keep[1:] = (x[1:] != SPACE) | (x[:-1] != SPACE)
        x = x[keep].astype(np.int64)
        old = len(carried)
        carried = x[-2:]
        if len(x) == old:
            continue
        letter = x != SPACE
        two = (x[:-1] << np.int64(21)) | x[1:]
        three = (two[:-1] << np.int64(21)) | x[2:]
        inner = letter[1:-1]
        inner[: max(0, old - 2)] = False
        found.append(np.unique(np.concatenate((x[old:][letter[old:]], two[old - 1 :], three[inner])), return_counts=True))
    return merged(found)


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several (sorted grams, counts)."""
    if len(found) == 1:
        return found[0]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, back = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    return codes, np.bincount(back, weights=np.concatenate([n for _, n in found])).astype(np.int64)


def top_grams(text: str, size: int) -> np.ndarray:
    """The text's ``size`` most frequent n-grams, most frequent first (ties: smaller code)."""
    codes, counts = grams_of(text)
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(rows: DataFrame, text_col: str, lang_col: str, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Ranked n-grams per language, counted over all rows with a text and a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                parts = held.setdefault(lang.as_py(), [])
                parts.append(grams_of(text.as_py()))
                if len(parts) >= 512:
                    parts[:] = [merged(parts)]
        for lang, parts in held.items():
            codes, counts = merged(parts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "gram": codes, "n": counts})

    known = rows.select(quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = known.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    out: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """Profiles as one rank table: rows are n-grams, columns are languages."""

    def __init__(self, learned: dict[str, list[int]], size: int) -> None:
        self.size = size
        self.langs = sorted(learned)
        self.grams = np.unique(np.concatenate([np.array(g, np.int64) for g in learned.values()] or [np.empty(0, np.int64)]))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, dtype=np.int32)
        for j, lang in enumerate(self.langs):
            at = np.searchsorted(self.grams, np.array(learned[lang], np.int64))
            self.ranks[at, j] = np.arange(len(at))

    def predict(self, text: str) -> tuple[str, float]:
        grams = top_grams(text, self.size)
        if not len(grams) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = len(self.grams) - 1
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        ranks = self.ranks[at]
        away = np.abs(ranks - np.arange(len(grams), dtype=np.int32)[:, None])
        total = np.where(ranks < 0, self.size, np.minimum(away, self.size)).sum(axis=0)
        best = int(np.argmin(total))
        return self.langs[best], 1.0 - float(total[best]) / (self.size * len(grams))


def identify(df: DataFrame, learned: dict[str, list[int]], text_col: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (1 - normalised distance to the winner, 0 to 1) to every row."""
    shared = df.sparkSession.sparkContext.broadcast(Profiles(learned, size))

    def rows(texts: Iterator[bytes | None]) -> Iterator[tuple]:
        profiles = shared.value
        for text in texts:
            yield profiles.predict(text.decode()) if text else ("und", 0.0)

    return with_text_columns(df, text_col, StructType.fromDDL("lang_pred string, score double"), rows)


def q_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    # A null id is not held out: its row is learned from.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    learned = learn_profiles(docs.where(~held_out), "text", "lang")
    judged = identify(docs.select("doc_id", "text"), learned)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
