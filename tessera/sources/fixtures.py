"""Views of the given tables shaped like the inputs the analyses read.

Each view is derived by Spark from the parquet tables, so its size grows with
them.  Text inputs are rendered inside Spark and parsed back by the sources
in ``tessera.sources.text``.  The SQL twins used by the oracle live in
``tessera.plans.views`` and follow the same definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

# The header line of a scored-pair file; only its first token, the header marker, matters.
PAIR_HEADER = "id_1,id_2," + ",".join(f"score_{i}" for i in range(1, 10)) + ",is_match"

# Positions of the derived fixtures (fixture design, not reference values).
NO_TAB_EVERY = 97
BAD_ID_EVERY = 89
CR_EVERY = 7
EMPTY_ALIAS_EVERY = 101
SPLIT_MOD = 1000


def _returnflag_index(c="l_returnflag"):
    return F.when(F.col(c) == "A", 0.0).when(F.col(c) == "N", 1.0).otherwise(2.0)


def pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Typed scored pairs: (id1, id2, scores[9], matched) from lineitem ⋈ orders ⋈ part ⋈ supplier."""
    l = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    j = (
        l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    size = F.col("p_size").cast("double")
    scores = F.array(
        F.col("l_quantity"),
        F.col("l_extendedprice"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")),
        F.col("l_tax"),
        F.col("o_totalprice"),
        F.col("p_retailprice"),
        F.when(F.col("p_size") % 10 != 0, size),
        F.col("s_acctbal"),
        size / 50.0,
    )
    return j.select(
        F.col("l_orderkey").cast("int").alias("id1"),
        F.col("l_partkey").cast("int").alias("id2"),
        scores.alias("scores"),
        (F.col("l_returnflag") == "R").alias("matched"),
    )


def render_pairs(rows: DataFrame) -> DataFrame:
    """Scored pairs as CSV lines with ``?`` for missing."""
    text = F.array_join(F.col("scores").cast("array<string>"), ",", "?")
    line = F.concat_ws(",", F.col("id1").cast("string"), F.col("id2").cast("string"), text, F.col("matched").cast("string"))
    # Exploded from an array of one: a filter on the line, as that for headers, then reads it instead of rendering it again.
    return rows.select(F.explode(F.array(line)).alias("value"))


def pair_lines(spark: SparkSession, sf: str) -> DataFrame:
    # The header depends on a column so the optimizer cannot fold parsers over it at planning time.
    header = spark.range(1).select(F.concat(F.lit(PAIR_HEADER), F.substring(F.col("id").cast("string"), 1, 0)).alias("value"))
    return header.unionByName(render_pairs(pair_rows(spark, sf)))


def rating_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, rating, k1, k2): customer, part and quantity of each line item; k1/k2 key the split."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        F.col("l_quantity").cast("int").cast("double").alias("rating"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").cast("long").alias("k2"),
    )


def rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Space-delimited ``user item count`` lines."""
    r = rating_rows(spark, sf)
    return r.select(F.concat_ws(" ", "user", "item", F.col("rating").cast("int")).alias("value"))


def item_lines(spark: SparkSession, sf: str, with_bad: bool = True) -> DataFrame:
    """``id<TAB>name`` lines of part; some end in a carriage return; optionally some bad lines."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    good = F.concat(k.cast("string"), F.lit("\t"), F.col("p_name"), F.when(k % CR_EVERY == 0, F.lit(" \r")).otherwise(F.lit("")))
    if with_bad:
        line = (
            F.when(k % NO_TAB_EVERY == 0, F.concat(k.cast("string"), F.lit(" "), F.col("p_name")))
            .when(k % BAD_ID_EVERY == 0, F.concat(F.lit("x"), k.cast("string"), F.lit("\t"), F.col("p_name")))
            .otherwise(good)
        )
    else:
        line = good
    return p.select(line.alias("value"), k.alias("ord"))


def alias_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``bad<TAB>good`` lines: a part maps to the least key among parts of equal name, brand and type."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    canon = p.groupBy("p_name", "p_brand", "p_type").agg(F.min("p_partkey").alias("good"))
    j = p.join(canon, ["p_name", "p_brand", "p_type"]).filter(F.col("p_partkey") != F.col("good"))
    k = F.col("p_partkey")
    line = F.when(k % EMPTY_ALIAS_EVERY == 0, F.concat(F.lit("\t"), F.col("good").cast("string"))).otherwise(
        F.concat(k.cast("string"), F.lit("\t"), F.col("good").cast("string"))
    )
    return j.select(line.alias("value"), k.alias("ord"))


def labeled_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as numeric CSV: 64 features then the 1-based class."""
    e = table(spark, sf, "embeddings")
    feats = F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ",")
    return e.select(F.concat_ws(",", feats, (F.col("label") + 1).cast("double").cast("string")).alias("value"), "vec_id")


def scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(label, prediction) per line item: label = return-flag index, prediction from a fixed rule."""
    l = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_tax")
    pred = F.when(F.col("l_quantity") < 17, 0.0).when(F.col("l_tax") < 0.04, 1.0).otherwise(2.0)
    return l.select(_returnflag_index().alias("label"), pred.alias("prediction"))


def labeled_cat_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as numeric CSV with one-hot blocks: 6 numerics, type (6), brand (25), then the 1-based class.

    Category sets come from the part dimension (small, size-checked) and are
    applied as literal lists, so the fact table is read once.
    """
    from tessera.operators.features import index_expr, one_hot_block, small_categories

    l = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type", "p_brand")
    cats = small_categories(p, ["p_type", "p_brand"])
    if cats is None:
        raise ValueError("too many part types or brands for a one-hot fixture")
    j = l.join(p, F.col("l_partkey") == F.col("p_partkey"))
    vals = F.concat(
        F.array(
            F.col("l_quantity"),
            F.col("l_extendedprice"),
            F.col("l_discount"),
            F.col("l_tax"),
            F.col("p_size").cast("double"),
            F.col("p_retailprice"),
        ),
        one_hot_block(index_expr("p_type", cats["p_type"]), len(cats["p_type"])),
        one_hot_block(index_expr("p_brand", cats["p_brand"]), len(cats["p_brand"])),
        F.array(_returnflag_index() + 1.0),
    )
    return j.select(
        F.array_join(vals.cast("array<string>"), ",").alias("value"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").cast("long").alias("k2"),
    )


def mixed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Network-record-like CSV: quantity, three categoricals, five numerics, label = part type."""
    l = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_extendedprice", "l_discount", "l_tax"
    )
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        F.concat_ws(
            ",",
            F.col("l_quantity").cast("string"),
            "l_returnflag",
            "o_orderstatus",
            "o_orderpriority",
            F.col("l_extendedprice").cast("string"),
            F.col("l_discount").cast("string"),
            F.col("l_tax").cast("string"),
            F.col("p_size").cast("double").cast("string"),
            F.col("p_retailprice").cast("string"),
            "p_type",
        ).alias("value")
    )


def embedding_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, label, features array<double>)."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))


def label_centers(spark: SparkSession, sf: str) -> DataFrame:
    """(cluster, pos, value): the mean embedding of each label, a stand-in for fitted centres."""
    e = embedding_rows(spark, sf)
    return (
        e.select(F.col("label").alias("cluster"), F.posexplode("features").alias("pos", "x"))
        .groupBy("cluster", "pos")
        .agg(F.avg("x").alias("value"))
    )
