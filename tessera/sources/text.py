"""Delimited-text sources and sinks.

Lines come in as a DataFrame with one string column (``value`` by default, as
``spark.read.text`` yields).  Parsers are column expressions over ``split`` so
they run inside the scan stage; strict parsers fail the job on a bad line
(as the JVM ``toInt``/``toDouble`` would), lenient ones drop it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs as X

# Fixed value: a header line of the scored-pair files carries this token.
HEADER_MARKER = "id_1"


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line of a file or directory."""
    lines = spark.read.text(path)
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        lines = lines.repartition(min_partitions)
    return lines


def split_header(lines: DataFrame, marker: str = HEADER_MARKER, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(data lines, header lines); every line holding ``marker`` is a header, in any file."""
    is_header = F.col(col).contains(marker)
    return lines.filter(~is_header), lines.filter(is_header)


def _fields(col: str, sep: str):
    # Spark's split keeps trailing empty strings; width checks below reject those lines.
    return F.split(F.col(col), sep, -1)


def _csv(lines: DataFrame, col: str, fields: list[tuple[str, str]], sep: str, null_value: str | None = None) -> DataFrame:
    """Parse each line with Spark's CSV reader into typed fields (``_r.<name>``).

    FAILFAST: a value that does not parse as its type, a line with the wrong
    number of fields, or an empty field (which the reader would turn into NULL)
    fails the job.  Ints, doubles and booleans parse with the JVM's own rules;
    quoting is off so a line splits exactly at ``sep``.
    """
    ddl = ", ".join(f"`{n}` {t}" for n, t in fields)
    opts = {"mode": "FAILFAST", "sep": sep, "quote": "", "escape": ""}
    if null_value is not None:
        opts["nullValue"] = null_value
    c = F.col(col)
    # A line end at the end of the value does not hide an empty last field.
    ends = [c.endswith(sep), *[c.endswith(sep + e) | (c == e) for e in ("\n", "\r", "\r\n", "\u0085", "\u2028", "\u2029")]]
    empty = (c == "") | c.startswith(sep) | c.contains(sep * 2) | reduce(or_, ends)
    return F.from_csv(F.when(empty, X.fail("empty field")).otherwise(c), ddl, opts)


def parse_scored_pairs(lines: DataFrame, col: str = "value", n_scores: int = 9) -> DataFrame:
    """S3: ``id1,id2,s1..s9,matched`` → (id1 int, id2 int, scores array<double>, matched boolean).

    ``?`` (and NaN) become NULL; a malformed line fails the job.
    """
    fields = [("id1", "int"), ("id2", "int")] + [(f"s{i}", "double") for i in range(n_scores)] + [("matched", "boolean")]
    r = lines.select(_csv(lines, col, fields, ",", X.MISSING_MARKER).alias("_r"))
    ids_ok = F.col("_r.id1").isNotNull() & F.col("_r.id2").isNotNull() & F.col("_r.matched").isNotNull()
    return r.select(
        F.when(ids_ok, F.col("_r.id1")).otherwise(X.fail("malformed scored pair")).alias("id1"),
        F.col("_r.id2").alias("id2"),
        F.array(*[X.nan_to_null(F.col(f"_r.s{i}")) for i in range(n_scores)]).alias("scores"),
        F.col("_r.matched").alias("matched"),
    )


def field_count(lines: DataFrame, col: str = "value", sep: str = ",") -> int:
    """Number of fields of the first line (as the reference reads the width off the first record)."""
    row = lines.select(F.size(_fields(col, sep)).alias("n")).first()
    if row is None:
        raise ValueError("no lines")
    return int(row["n"])


def parse_labeled(
    lines: DataFrame, n_features: int | None = None, col: str = "value", sep: str = ",", keep=(), width: int | None = None
) -> DataFrame:
    """All numbers but the last are features (or only the first ``n_features``); label = last − 1.

    ``width`` is the number of fields per line (read off the first line when
    not given); every field of every line is parsed, so a bad value anywhere
    fails the job as in the reference.
    """
    width = width or field_count(lines, col, sep)
    fields = [(f"f{i}", "double") for i in range(width)]
    r = lines.select(*keep, _csv(lines, col, fields, sep).alias("_r"))
    n = width - 1 if n_features is None else min(n_features, width - 1)
    return r.select(
        *keep,
        (F.col(f"_r.f{width - 1}") - 1.0).alias("label"),
        F.array(*[X.nan_to_null(F.col(f"_r.f{i}")) for i in range(n)]).alias("features"),
    )


def parse_mixed(lines: DataFrame, col: str = "value", sep: str = ",", drop_from: int = 1, drop_count: int = 3, width: int | None = None) -> DataFrame:
    """Drop the categorical columns ``[drop_from, drop_from+drop_count)``; last column is the string label."""
    df = parse_mixed_categorical(lines, col, sep, tuple(range(drop_from, drop_from + drop_count)), width)
    return df.select("label", "features")


def parse_triples(lines: DataFrame, col: str = "value", sep: str = " ", names=("user", "item", "count"), keep=()) -> DataFrame:
    """``user item count`` integers; a line without three integers fails the job."""
    r = lines.select(*keep, _csv(lines, col, [(n, "int") for n in names], sep).alias("_r"))
    ok = F.col(f"_r.{names[0]}").isNotNull() & F.col(f"_r.{names[1]}").isNotNull() & F.col(f"_r.{names[2]}").isNotNull()
    return r.select(
        *keep,
        F.when(ok, F.col(f"_r.{names[0]}")).otherwise(X.fail("malformed triple")).alias(names[0]),
        *[F.col(f"_r.{n}").alias(n) for n in names[1:]],
    )


def _id_and_rest(col: str):
    v = F.col(col)
    tab = F.instr(v, "\t")
    ident = F.when(tab > 0, F.substring_index(v, "\t", 1)).otherwise(v)
    rest = F.when(tab > 0, F.expr(f"substring(`{col}`, instr(`{col}`, '\t'))")).otherwise(F.lit(""))
    return ident, rest


def parse_names_strict(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id<TAB>name`` → (id, trimmed name); a non-integer id fails the job."""
    ident, rest = _id_and_rest(col)
    return lines.select(X.strict_int(ident, "id").alias("id"), X.jvm_trim(rest).alias("name"))


def parse_names_lenient(lines: DataFrame, col: str = "value") -> DataFrame:
    """As S8 but a line without a tab, or with a non-integer id, is dropped."""
    ident, rest = _id_and_rest(col)
    parsed = lines.select(X.lenient_int(ident).alias("id"), rest.alias("_rest"))
    return parsed.filter((F.col("_rest") != "") & F.col("id").isNotNull()).select(
        "id", X.jvm_trim("_rest").alias("name")
    )


def parse_aliases(lines: DataFrame, col: str = "value", order_col: str | None = None) -> DataFrame:
    """``bad<TAB>good`` ids; lines with an empty first token are dropped.

    When a bad id repeats, the pair with the greatest ``order_col`` wins (the
    reference keeps the last one read; an explicit order makes that stable).
    Without an order column the pair with the greatest good id wins.
    """
    a = F.split(F.col(col), "\t", -1)
    cols = [a.alias("_t")] + ([F.col(order_col).alias("_o")] if order_col else [])
    # The keep-condition sits inside each parse expression, so no filter the
    # optimizer moves below it can expose a dropped line to the strict casts.
    keep = F.col("_t")[0] != ""
    df = lines.select(*cols).select(
        F.when(keep, X.strict_int(F.col("_t")[0], "alias id")).alias("bad"),
        F.when(keep, X.strict_int(F.get(F.col("_t"), 1), "canonical id")).alias("good"),
        *([F.col("_o")] if order_col else []),
    ).filter(F.col("bad").isNotNull())
    order = F.col("_o") if order_col else F.col("good")
    return df.groupBy("bad").agg(F.max_by("good", order).alias("good"))


def parse_cluster_sample(lines: DataFrame, col: str = "value", sep: str = ",", width: int | None = None) -> DataFrame:
    """``cluster,f1,...,fn`` → (cluster int, features array<double>), all features kept."""
    width = width or field_count(lines, col, sep)
    fields = [("cluster", "int")] + [(f"f{i}", "double") for i in range(1, width)]
    r = lines.select(_csv(lines, col, fields, sep).alias("_r"))
    return r.select(
        F.col("_r.cluster").alias("cluster"),
        F.array(*[X.nan_to_null(F.col(f"_r.f{i}")) for i in range(1, width)]).alias("features"),
    )


def render_cluster_sample(df: DataFrame, cluster_col: str = "cluster", features_col: str = "features") -> DataFrame:
    """Lines ``cluster,f1,...`` for S12."""
    return df.select(
        F.concat_ws(",", F.col(cluster_col).cast("string"), X.doubles_text(features_col)).alias("value")
    )


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Write one string column as text; by default fails if ``path`` exists."""
    w = lines.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def read_csv_dir(spark: SparkSession, path: str, first_col: str = "cluster", width: int | None = None) -> DataFrame:
    """A directory of headerless CSV parts → (first column as int, remaining columns as array<double>)."""
    out = parse_cluster_sample(spark.read.text(path), width=width)
    return out.withColumnRenamed("cluster", first_col) if first_col != "cluster" else out


def parse_mixed_categorical(lines: DataFrame, col: str = "value", sep: str = ",", cat_positions=(1, 2, 3), width: int | None = None) -> DataFrame:
    """S6 keeping the categorical fields: (line, label, c1..cn, numeric features)."""
    width = width or field_count(lines, col, sep)
    cats = {p: f"c{n + 1}" for n, p in enumerate(cat_positions)}
    fields = []
    for i in range(width - 1):
        fields.append((cats[i], "string") if i in cats else (f"f{i}", "double"))
    fields.append(("label", "string"))
    r = lines.select(F.col(col).alias("line"), _csv(lines, col, fields, sep).alias("_r"))
    numeric = [i for i in range(width - 1) if i not in cats]
    return r.select(
        "line",
        F.col("_r.label").alias("label"),
        *[F.col(f"_r.{c}").alias(c) for c in cats.values()],
        F.array(*[X.nan_to_null(F.col(f"_r.f{i}")) for i in numeric]).alias("features"),
    )
