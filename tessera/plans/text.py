"""Text queries: TF-IDF over whole documents and the XML page-dump reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators import features
from tessera.plans.views import with_views
from tessera.session import scratch_path, table
from tessera.sources import xml

TOP_TERMS = 10


def weights(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return features.tfidf(docs)


def q_tfidf(spark, sf):
    return weights(spark, sf).select("doc_id", "term", "tf", "doc_terms", "df", X.round6("weight").alias("weight"))


def q_tfidf_top_terms(spark, sf):
    w = weights(spark, sf).withColumn("weight", X.round6("weight"))
    return features.top_terms(w, TOP_TERMS).select("doc_id", "term", "weight", "rank")


def q_term_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    t = features.tokenize(docs)
    return t.groupBy("term").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("doc_id").alias("docs"))


def q_xml_pages(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("title"), F.lit(0).cast("long").alias("ns"), F.col("html").alias("text")
    )
    path = scratch_path(spark, "wiki-xml")
    xml.write_wiki_pages(pages, path)
    back = xml.read_wiki_pages(spark, path)
    return back.select(
        F.col("id").alias("page_id"), F.col("title").alias("url"), F.md5("text").alias("text_md5"), F.length("text").alias("text_chars")
    )


_TFIDF = with_views("corpus") + """, tf AS (SELECT doc_id, term, count(*) AS tf FROM corpus GROUP BY doc_id, term),
pd AS (SELECT doc_id, sum(tf) AS doc_terms FROM tf GROUP BY doc_id),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf, pd.doc_terms, dfq.df,
             round((tf.tf / pd.doc_terms) * ln(nd.n / dfq.df), 6) AS weight
      FROM tf JOIN pd USING (doc_id) JOIN dfq USING (term) CROSS JOIN nd)
"""

SQL = {
    "tfidf": _TFIDF + "SELECT doc_id, term, tf, CAST(doc_terms AS INTEGER) AS doc_terms, df, weight FROM w",
    "tfidf_top_terms": _TFIDF
    + f"""SELECT doc_id, term, weight, rank FROM (
  SELECT doc_id, term, weight, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS INTEGER) AS rank FROM w)
WHERE rank <= {TOP_TERMS}""",
    "term_counts": with_views("corpus") + "SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS docs FROM corpus GROUP BY term",
    "xml_pages": "SELECT page_id, url, md5(html) AS text_md5, CAST(length(html) AS INTEGER) AS text_chars FROM pages",
}

QUERIES = {
    "tfidf": q_tfidf,
    "tfidf_top_terms": q_tfidf_top_terms,
    "term_counts": q_term_counts,
    "xml_pages": q_xml_pages,
}
