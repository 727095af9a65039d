"""Session helpers: defaults every job relies on, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the library needs for correct, comparable results.  All are
# SQL confs, so they can be applied to a session the caller already owns.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # array-heavy pandas UDF inputs: keep Arrow batches moderate
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def build_session(master: str = "local[*]", app: str = "textlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster use the provided one."""
    b = SparkSession.builder.master(master).appName(app)
    b = b.config("spark.ui.enabled", "false")
    b = b.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a private folder; on a
    cluster a driver-local folder would be invisible to the executors, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="textlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for written intermediates."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/textlens-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read
    it back: lineage is cut, the stage survives executor loss, and (unlike an
    eager ``checkpoint()``, which runs the plan a second time to write it) the
    plan is computed exactly once.  Never a local checkpoint.  zstd, as the
    folder keeps every stage of a job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def one_row_batches(spark: SparkSession) -> Iterator[None]:
    """Python gets one row at a time, as a row holds whole blocks; the plans must be run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)
