"""Quality rules by compression bands.

A text is compressed with zstandard as a whole and in fixed chunks; the ratio
compressed/raw must lie inside a band that depends on the text's length (short
texts compress worse than long ones).  Repetitive text falls below its band,
incompressible text (encoded blobs, random keys) above it.

Base rules come first: too few words, or too many words inside repeated 3-word
windows.

Cases: a null or empty text has no words and fails the base rules; a text
shorter than one chunk is one chunk; a last partial chunk is measured by the
last ``chunk_bytes`` of the text; equal rows get equal verdicts; an empty table gives an empty
result; result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import covered, give_back, quoted, read_table, window_codes, with_text_columns, word_ids


@dataclass(frozen=True)
class Band:
    """Texts of fewer than ``below`` bytes must have a ratio in [low, high]."""

    below: float
    low: float
    high: float


WHOLE_BANDS = (
    Band(512, 0.45, 0.85),
    Band(1024, 0.45, 0.80),
    Band(2048, 0.44, 0.75),
    Band(4096, 0.42, 0.70),
    Band(16384, 0.38, 0.68),
    Band(131072, 0.33, 0.65),
    Band(float("inf"), 0.28, 0.65),
)
CHUNK_BANDS = (Band(512, 0.45, 0.85), Band(1024, 0.45, 0.80), Band(2048, 0.44, 0.75), Band(float("inf"), 0.42, 0.70))


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    window: int = 3
    level: int = 3
    chunk_bytes: int = 2048
    #: A text is rejected when more than this share of its chunks is outside the band.
    max_bad_chunks: float = 0.25
    whole: Sequence[Band] = WHOLE_BANDS
    chunks: Sequence[Band] = CHUNK_BANDS


SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, ratio double, chunk_low double, chunk_high double, bad_chunks long, reason string"
)


def band_of(size: int, bands: Sequence[Band]) -> Band:
    return next(b for b in bands if size < b.below)


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text."""
    n = len(words)
    if n < window:
        return 0
    _, codes, counts = np.unique(window_codes(word_ids(words), window), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[codes] > 1)
    return int(covered(starts, window, n).sum()) if len(starts) else 0


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def verdict(text: bytes, params: QualityParams, z: zstandard.ZstdCompressor) -> tuple:
    """(passes, whole ratio, lowest and highest chunk ratio, chunks outside their band, reason)."""
    size = len(text)
    ratio = len(z.compress(text)) / size
    step = params.chunk_bytes
    parts = [text[i : i + step] for i in range(0, size - step + 1, step)] or [text]
    if size > step and size % step:
        parts.append(text[-step:])  # of full length, so the same band holds
    band = band_of(len(parts[0]), params.chunks)
    found = [len(z.compress(p)) / len(p) for p in parts]
    bad = sum(not band.low <= r <= band.high for r in found)
    whole = band_of(size, params.whole)
    reason = None
    if ratio < whole.low:
        reason = "repetitive"
    elif ratio > whole.high:
        reason = "incompressible"
    elif bad > params.max_bad_chunks * len(parts):
        reason = "chunks"
    return reason is None, ratio, min(found), max(found), bad, reason


def compression_bands(df: DataFrame, text_col: str = "text", params: QualityParams = QualityParams()) -> DataFrame:
    """Add word statistics, base verdict, compression ratios and ``kept`` to every row."""
    def rows(texts: Iterator[bytes | None]) -> Iterator[tuple]:
        z = zstandard.ZstdCompressor(level=params.level)
        for text in texts:
            text = text or b""
            words = text.split()
            n = len(words)
            chars = len(b"".join(words).decode("utf-8", "replace"))
            symbols = sum(text.count(s) for s in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))
            repeated = repeat_words(words, params.window)
            failed = n < params.min_words or 100 * repeated > params.max_repeat_percent * n
            head = (n, chars, symbols, duplicate_lines(text), repeated, failed)
            if failed:
                yield *head, False, None, None, None, None, "base"
            else:
                ok, ratio, low, high, bad, reason = verdict(text, params, z)
                yield *head, ok, ratio, low, high, bad, reason
        give_back()

    return with_text_columns(df, text_col, StructType.fromDDL(SCHEMA), rows)


def keep_good(docs: DataFrame, text_col: str = "text", params: QualityParams = QualityParams()) -> DataFrame:
    """The documents that pass, with their own columns."""
    text, row = "_text", "_row"
    judged = compression_bands(docs.select(quoted(text_col).alias(text), F.struct(*[quoted(c) for c in docs.columns]).alias(row)), text, params)
    return judged.where("kept").select(*[F.col(row).getField(c).alias(c) for c in docs.columns])


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression_bands(docs).drop("text")
