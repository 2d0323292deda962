"""Session helpers: a tuned local session for tests, shared scratch space and table loading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job wants as well: adaptive execution re-plans joins from
# runtime sizes, coalesces small shuffle partitions and splits skewed ones.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in ADAPTIVE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is only read (it is a static
    setting).  Without it, the context's checkpoint folder is used if one was
    set.  Where neither exists a machine-local folder is made, but only for a
    local master: on a cluster other machines could not read it, so there this
    raises.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Rows written once to the shared checkpoint folder as Parquet (with the writer's ``options``) and read back: what is read again is not computed again."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
