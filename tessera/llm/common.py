"""Helpers shared by the operators of this package.

Conventions all operators follow:

* A null text is an empty text unless an operator says otherwise.
* Operators select the columns they need before they add any, and result
  columns replace input columns of the same name, so extra input columns never
  clash.
* ``bytes.split()`` splits on exactly ``[\\x20\\x09-\\x0D]``, so words are cut from
  UTF-8 bytes; ``bytes.lower()`` lowers exactly A-Z.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: no lineage, the same rows for every later use."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until it clashes with none of ``taken`` (Spark ignores case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def with_text_columns(
    df: DataFrame, text_col: str, schema: StructType, rows: Callable[[Iterator[bytes | None]], Iterable[tuple]]
) -> DataFrame:
    """Add the columns of ``schema`` computed per text.

    ``rows`` maps an iterator over the texts of one Arrow batch (UTF-8 bytes,
    None for null) to one tuple per text.  Spark bounds a batch by rows and
    bytes, so memory is that of a batch plus the largest single text.
    """
    kind = pa.struct([pa.field(f.name, to_arrow(f.dataType.simpleString())) for f in schema.fields])

    def evaluate(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.large_binary())
        out = list(rows(v.as_py() for v in raw))
        cols = [pa.array([r[i] for r in out], type=f.type) for i, f in enumerate(kind)]
        return pa.StructArray.from_arrays(cols, fields=list(kind))

    udf = F.arrow_udf(evaluate, schema)
    tmp = free_name("_computed", df.columns)
    keep = [quoted(c) for c in df.columns if c not in schema.names]
    out = df.withColumn(tmp, udf(quoted(text_col).cast("string")))
    return out.select(*keep, *[F.col(tmp)[n].alias(n) for n in schema.names])


def to_arrow(simple: str) -> pa.DataType:
    known = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }
    if simple.startswith("array<"):
        return pa.list_(to_arrow(simple[6:-1]))
    return known[simple]


def give_back() -> None:
    """Return freed memory to the system: Python workers live on, and the stages after one that needed
    much would otherwise start on top of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU allocator has it
    if trim:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift rounds) on uint64 arrays."""
    x = x ^ (x >> np.uint64(30))  # a copy; the rest is done in place
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_ids(words: list[bytes]) -> np.ndarray:
    """Dense ids of the words within one text, in order of first appearance."""
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    return np.fromiter((put(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def window_codes(ids: np.ndarray, length: int) -> np.ndarray:
    """One int64 per window of ``length`` neighbouring ids; equal windows have equal codes."""
    n = len(ids) - length + 1
    bits = max(1, int(ids.max()).bit_length())
    if bits * length <= 63:
        codes = ids[:n].copy()
        for k in range(1, length):
            codes = (codes << np.int64(bits)) | ids[k : n + k]
        return codes
    codes = ids
    for k in range(1, length):
        _, dense = np.unique(codes, return_inverse=True)
        m = len(ids) - k
        codes = (dense[:m].astype(np.int64) << np.int64(31)) | ids[k:]
    return codes


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask over n positions covered by windows of ``length`` at the given starts."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) rows of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)
