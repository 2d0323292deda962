"""Column expressions with the value semantics the analyses rely on.

All of these are built from Spark SQL built-ins so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JVM treats every char at or below U+0020 as whitespace in
# String.trim, while Spark's trim only removes spaces.
_JVM_WS = "[\\x00-\\x20]"
# Fixed value: the textual marker for a missing score.
MISSING_MARKER = "?"

_INT_PATTERN = "^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fail(message: str) -> Column:
    return F.raise_error(F.lit(message))


def jvm_trim(c) -> Column:
    """Trim all control chars and spaces (<= U+0020) at both ends."""
    return F.regexp_replace(_col(c), f"^{_JVM_WS}+|{_JVM_WS}+$", "")


def lenient_int(c) -> Column:
    """Integer parse that yields NULL where the JVM parse would throw (F4, lenient).

    Unlike ``try_cast`` this rejects surrounding whitespace, as the JVM does.
    """
    c = _col(c)
    return F.when(c.rlike(_INT_PATTERN), c.try_cast("int"))


def strict_int(c, what: str = "integer") -> Column:
    """Integer parse that fails the job on a bad value (F4, strict)."""
    v = lenient_int(c)
    return F.when(v.isNotNull(), v).otherwise(fail(f"malformed {what}"))


def lenient_double(c) -> Column:
    """Double parse; NULL for a non-number.

    Spark's cast trims surrounding whitespace and accepts the JVM spellings
    (exponents, ``NaN``, ``Infinity``, ``d``/``f`` suffixes), so one ``try_cast``
    stands in for ``toDouble``.
    """
    return _col(c).try_cast("double")


def strict_double(c) -> Column:
    v = lenient_double(c)
    return F.when(v.isNotNull(), v).otherwise(fail("malformed double"))


def nan_to_null(c) -> Column:
    """Missing is NULL inside the library: map NaN to NULL once at the edge (§1)."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def null_to_zero(c) -> Column:
    """``naz``: missing counts as 0."""
    return F.coalesce(_col(c), F.lit(0.0))


def array_sum(c) -> Column:
    """Sum of an array in element order."""
    return F.aggregate(_col(c), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def euclidean(a, b) -> Column:
    """Euclidean distance of two equal-length arrays, summed in position order."""
    return F.sqrt(squared_distance(a, b))


def one_hot_position(c, start: int, length: int) -> Column:
    """0-based position of the first 1.0 in ``c[start : start+length]``; -1 if none."""
    return F.array_position(F.slice(_col(c), start + 1, length), F.lit(1.0)).cast("int") - 1


def doubles_text(c, sep: str = ",") -> Column:
    """``mkString`` of a double array (F8)."""
    return F.array_join(F.transform(_col(c), lambda x: x.cast("string")), sep)


def fixed_width_line(cluster, label, count) -> Column:
    """``f"$cluster%1s$label%18s$count%8s"``."""
    return F.format_string("%1s%18s%8s", _col(cluster), _col(label), _col(count))


def tfidf_weight(term_in_doc, terms_in_doc, docs_with_term, total_docs) -> Column:
    """``(tf / terms in doc) * ln(docs / docs containing term)``."""
    tf = _col(term_in_doc).cast("double") / _col(terms_in_doc)
    return tf * F.ln(_col(total_docs).cast("double") / _col(docs_with_term))


def round6(c) -> Column:
    return F.round(_col(c), 6)
