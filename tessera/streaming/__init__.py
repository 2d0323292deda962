"""Streaming entry points.

The reference has no streaming code: every source is a batch text scan.  The
text parsers in ``tessera.sources.text`` are pure column expressions, so the
same parsing applies unchanged to a Structured Streaming text source; this
module only opens such a source.  Parsers that read the line width off the
first record need ``width=`` on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: one row per line of each new file under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
