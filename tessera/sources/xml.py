"""XML page dumps.

A wiki dump is one large XML document of ``<page>`` elements.  Spark's built-in
XML reader splits it by ``rowTag`` across tasks, reads ``.bz2`` files directly
(bzip2 is a splittable codec) and, given an explicit schema, skips inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The element names of a MediaWiki export.
PAGE_TAG = "page"
ROOT_TAG = "mediawiki"

WIKI_PAGE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("ns", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField(
            "revision",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("text", T.StringType()),
                ]
            ),
        ),
    ]
)


def read_wiki_pages(spark: SparkSession, path: str, schema: T.StructType = WIKI_PAGE_SCHEMA) -> DataFrame:
    """Pages of a MediaWiki dump → (id, title, ns, text); a page with a bad field fails the job."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", PAGE_TAG)
        .option("mode", "FAILFAST")
        .option("ignoreSurroundingSpaces", "false")
        .schema(schema)
        .load(path)
    )
    return raw.select("id", "title", "ns", F.col("revision.text").alias("text"))


def write_wiki_pages(pages: DataFrame, path: str, compression: str | None = "bzip2", mode: str = "errorifexists") -> None:
    """Write (id, title, ns, text) rows in the dump layout, one ``<page>`` per row."""
    shaped = pages.select(
        "title",
        "ns",
        "id",
        F.struct(F.col("id").alias("id"), F.col("text").alias("text")).alias("revision"),
    )
    w = shaped.write.format("xml").mode(mode).option("rowTag", PAGE_TAG).option("rootTag", ROOT_TAG)
    if compression:
        w = w.option("compression", compression)
    w.save(path)
