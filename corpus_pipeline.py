"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on every document its
predecessor kept, and its decisions take effect; all but the last return the
columns of ``documents``.  Between stages the documents are written as Parquet in
the shared folder and read again, so no stage carries another's lineage.

1. ``quality``: documents that fail the word rules or leave the compression bands go.
2. ``near_duplicates``: of each group of near-duplicates (five-word shingles, similarity
   0.8 or more) the document with the smallest id stays.
3. ``repeated_spans``: byte strings of ``SPAN_BYTES`` that an earlier document (smaller id) has
   too are cut, whole characters only.  Fifty words have at least 99 bytes, so every
   repeated passage of over 50 words is cut, while shorter phrases stay.
4. ``decontaminate``: words inside occurrences of ten-word benchmark windows are cut;
   a document that is mostly such words goes.
5. ``packing``: the remaining texts become token pieces packed into sequences.

Cases (null, empty and long texts, ties, repeated rows, empty tables, extra
columns) are those of the operators; ``n_chars`` follows a changed text, and a
document whose whole text was cut stays with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, minhash, packing, quality, suffixes
from tessera.llm.common import held, read_table

SPAN_BYTES = 99


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def stage_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(docs, threshold=SPAN_BYTES)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", stage_quality),
    ("near_duplicates", stage_near_duplicates),
    ("repeated_spans", stage_repeated_spans),
    ("decontaminate", stage_decontaminate),
    ("packing", stage_packing),
]

#: Compression ratios, sketches and tokenizers have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
