"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import codes, decontaminate, langid, licenses, maxent, minhash, multiindex, packing, periodic, quality, suffixes, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.q_warc,
    "op2_quality": quality.q_quality,
    "op3_packing": packing.q_packing,
    "op4_langid": langid.q_langid,
    "op5_licenses": licenses.q_licenses,
    "op6_suffixes": suffixes.q_suffixes,
    "op7_minhash": minhash.q_minhash,
    "op8_maxent": maxent.q_maxent,
    "op9_urls": urls.q_urls,
    "op10_decontaminate": decontaminate.q_decontaminate,
    "op11_codes": codes.q_codes,
    "op12_nearest": multiindex.q_nearest,
    "op13_periodic": periodic.q_periodic,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op5_licenses": licenses.SQL,
    "op6_suffixes": suffixes.SQL,
    "op7_minhash": minhash.SQL,
    "op9_urls": urls.SQL,
    "op10_decontaminate": decontaminate.SQL,
    "op11_codes": codes.SQL,
    "op13_periodic": periodic.SQL,
}
