"""File-stream ingest: staged files -> document tables, every version of a file processed once.

A file is known by its identity: path, modification time and length.  Each run lists the staged files, drops the
identities that its ledger holds as completed (an anti-join) and writes the others to a pending folder, in files
of at most ``max_files_per_trigger`` rows.  A Structured Streaming query over that folder drives the work, one
pending file a micro-batch: its checkpoint says which batches are done, and a batch that a crash cut off is run
again, with the run and batch number it was pending under.  So new bytes under an old name, a once-empty file and
a failed one are taken up by the next run of the same checkpoint, and unchanged files are not.  (A stream over
the staged files themselves remembers only their paths.)

Every batch appends its rows (idempotent by content and name), writes its quarantine and status partitions and
then its ledger partition, all keyed by run and batch, so nothing of another batch is overwritten and a repeated
one adds nothing.  Last come the *completed* files: archived or deleted (W9) if they still are what was read.
Failed and empty files stay staged."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import ingest as IN
from ..session import reliable_checkpoint
from ..sources import listing as LS

MAX_FILES_PER_BATCH = 1000
IDENTITY = ["path", "modificationTime", "length"]
PENDING = "path string, modificationTime timestamp, length long, run_id string, run_ts string"
LEDGER = "path string, modificationTime timestamp, length long, object_name string, status string, run_id string, batch_id long"


def _folder(checkpoint: str, name: str, file_type: str) -> str:
    return f"{checkpoint.rstrip('/')}/{name}/{file_type}"


def _ledger(spark: SparkSession, checkpoint: str, file_type: str) -> DataFrame:
    fs, path = LS.file_system(spark, _folder(checkpoint, "ledger", file_type))
    return spark.read.schema(LEDGER).parquet(path.toString()) if fs.exists(path) else spark.createDataFrame([], LEDGER)


def pending_files(spark: SparkSession, staging_root: str, checkpoint: str, file_type: str) -> DataFrame:
    """Identities of the staged files of one type (``{root}/{type}s``) that no run has completed."""
    staged = LS.read_objects(spark, staging_root, f"{file_type}s").select(*IDENTITY)
    done = _ledger(spark, checkpoint, file_type).where("status = 'completed'").select(*IDENTITY)
    return staged.join(done, IDENTITY, "left_anti")


def post_process(spark: SparkSession, staging_root: str, done: list, mode: str, archive_dir: str | None) -> None:
    """Archive (move, keeping the relative path) or delete the objects of ``done`` rows (path, modificationTime
    in ms, length, object_name).  One that is gone, or is no longer what was read, is left alone."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path, millis, length, name in done:  # one batch's completed files, at most max_files_per_trigger
        fs, source = LS.file_system(spark, path)
        if not fs.exists(source):
            continue
        now = fs.getFileStatus(source)
        if (now.getModificationTime(), now.getLen()) != (millis, length):
            continue
        if mode == "delete":
            fs.delete(source, False)
        else:
            target = hadoop(archive_dir.rstrip("/") + "/" + name)
            fs.mkdirs(target.getParent())
            fs.rename(source, target)


def start_ingest(
    spark: SparkSession,
    staging_root: str,
    warehouse: str,
    checkpoint: str,
    file_type: str,
    run_ts: str,
    post: str = "off",
    archive_dir: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_BATCH,
    **job,
) -> StreamingQuery:
    """Finish what an interrupted run of this checkpoint left, list the staged files, and start the ingest of the
    new ones with ``availableNow``.  Status rows of every micro-batch go to ``{warehouse}/ingest_status``, a
    partition for each run and batch.  ``post``: ``off``, ``archive`` (to ``archive_dir``, which must lie outside
    of the staged files) or ``delete``, for completed files only.  ``job``: extractor, summarizer, embedder and
    collection of ``ingest_files``.  One run at a time may use a checkpoint."""
    if post not in ("off", "archive", "delete"):
        raise ValueError("post must be delete, archive or off")
    if post == "archive" and not archive_dir:
        raise ValueError("archive needs archive_dir")
    pending = _folder(checkpoint, "pending", file_type)
    ledger = _folder(checkpoint, "ledger", file_type)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.collect()  # the identities of one pending file, at most max_files_per_trigger
        if not rows:
            return
        run = rows[0]["run_id"]
        mine = (F.col("run_id") == run) & (F.col("batch_id") == batch_id)
        if _ledger(spark, checkpoint, file_type).where(mine).isEmpty():
            files = LS.read_paths(spark, [r["path"] for r in rows if r["length"]])
            empty = spark.createDataFrame([(r["path"], r["modificationTime"]) for r in rows if not r["length"]], "path string, modificationTime timestamp")
            files = files.unionByName(empty.select("path", "modificationTime", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))
            files = files.withColumn("object_name", LS.name_under(spark, staging_root, F.col("path")))
            plan = IN.ingest_files(files, file_type, warehouse, rows[0]["run_ts"], run_id=run, batch_id=batch_id, **job)
            status = reliable_checkpoint(plan)
            write_status(status, file_type, run, batch_id, warehouse)
            kept = status.select(*IDENTITY, "object_name", "status", F.lit(run).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id"))
            _overwrite(kept.coalesce(1), ["run_id", "batch_id"], ledger)
        if post != "off":
            done = _ledger(spark, checkpoint, file_type).where(mine & (F.col("status") == "completed"))
            done = done.select("path", F.unix_millis("modificationTime"), "length", "object_name").collect()
            post_process(spark, staging_root, [tuple(r) for r in done], post, archive_dir)

    def start() -> StreamingQuery:
        stream = spark.readStream.schema(PENDING).option("maxFilesPerTrigger", "1").parquet(pending)
        return (
            stream.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", _folder(checkpoint, "stream", file_type))
            .trigger(availableNow=True)
            .start()
        )

    fs, path = LS.file_system(spark, pending)
    if fs.exists(path):
        _finish(start())
    else:
        fs.mkdirs(path)
    new = reliable_checkpoint(pending_files(spark, staging_root, checkpoint, file_type))
    parts = -(-new.count() // max_files_per_trigger)
    if parts:
        run_id = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        dealt = new.select(*IDENTITY, F.lit(run_id).alias("run_id"), F.lit(run_ts).alias("run_ts")).repartition(parts)
        dealt.write.mode("append").option("maxRecordsPerFile", max_files_per_trigger).parquet(pending)
    return start()


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _overwrite(df: DataFrame, keys: list[str], location: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(location)


def write_status(status: DataFrame, file_type: str, run_id: str, batch_id: int, warehouse: str) -> None:
    """The status partition (of rows with their files' identity) of one batch of one run; a batch that is run again rewrites its own."""
    vectorized = F.col("vectorized") if "vectorized" in status.columns else F.lit(None)
    vectorized = F.when(F.col("length") > 0, vectorized)  # of an empty file there was nothing to vectorize
    rows = status.withColumn("vectorized", vectorized.cast("boolean")).drop(*IDENTITY)
    keys = {"file_type": F.lit(file_type), "run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")}
    _overwrite(rows.withColumns(keys), list(keys), warehouse.rstrip("/") + "/ingest_status")


def read_status(spark: SparkSession, warehouse: str) -> DataFrame:
    """The status rows of all runs."""
    types = "file_id string, filename string, status string, message string, processed_at timestamp_ntz, object_name string, "
    schema = types + "vectorized boolean, file_type string, run_id string, batch_id long"
    fs, path = LS.file_system(spark, warehouse.rstrip("/") + "/ingest_status")
    return spark.read.schema(schema).parquet(path.toString()) if fs.exists(path) else spark.createDataFrame([], schema)


def current_status(status: DataFrame) -> DataFrame:
    """Of a history of status rows the last one of each object (run ids follow the time)."""
    rest = [c for c in status.columns if c not in ("object_name", "run_id", "batch_id")]
    last = F.max(F.struct("run_id", "batch_id", *rest)).alias("last")
    newest = status.groupBy("object_name").agg(last)
    return newest.select(*[F.col(c) if c == "object_name" else F.col(f"last.{c}").alias(c) for c in status.columns])


def run_ingest(spark: SparkSession, staging_root: str, warehouse: str, checkpoint: str, file_type: str, run_ts: str, **kw) -> None:
    """Start, wait for completion, surface any failure."""
    _finish(start_ingest(spark, staging_root, warehouse, checkpoint, file_type, run_ts, **kw))
