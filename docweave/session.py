"""Session construction and the shared checkpoint folder.

On a cluster the session is built by the launcher; ``get_spark`` only fills in settings that are
still unset, so cluster-wide choices (time zone, shuffle partitions, checkpoint folder) win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on.  Applied only where the session leaves them unset.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long documents: keep Arrow batches small so one batch of texts stays well inside memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
# Start-up settings, used only when this call starts the session.
LAUNCH_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_spark(master: str | None = None, app: str = "docweave", conf: dict | None = None) -> SparkSession:
    """The running session, or a new one.  ``conf`` is the caller's explicit choice and is always
    applied; the defaults only fill settings that neither the launcher nor the session has set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if SparkSession.getActiveSession() is None:
        launcher = SparkConf()
        for key, value in LAUNCH_CONF.items():
            if not launcher.contains(key):
                builder = builder.config(key, value)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = {r["key"] for r in spark.sql("SET").collect()}
    for key, value in DEFAULT_CONF.items():
        if key not in given:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Only a local master without one (tests, single-machine
    runs) gets a private folder; on a cluster an unset folder is an error, because a machine-local
    one would be invisible to the other machines."""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="docweave-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder (survives executor loss, unlike a
    local checkpoint).  Used after expensive or non-repeatable stages such as external embedding."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bound_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Rows of an Arrow batch, where neither the session nor its launcher has set them: Spark's own 10,000 whole
    texts are held by the JVM and again by the Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in {r["key"] for r in spark.sql("SET").collect()}:
        spark.conf.set(key, str(rows))


def bound_bytes(spark: SparkSession, megabytes: int = 16) -> None:
    """Bytes of an Arrow batch, where neither the session nor its launcher has set them: a batch of long texts is
    cut by what it holds, one of short texts by its rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in {r["key"] for r in spark.sql("SET").collect()}:
        spark.conf.set(key, str(megabytes << 20))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer tasks than the session has cores.

    A file scan cannot be split below one parquet row group, so a small table in one row group is read
    by one task, and per-row CPU work (regexes, chunking, scoring) would use one core.  The result is
    the same rows; a scan with enough splits, as any large table has, is returned as it is.  All reads of
    the library's tables go through this (``sources.tables.read_table``)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
