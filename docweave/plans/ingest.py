"""Batch ingest of staged files into the document tables.

The reference processes one file at a time (download, record, append, archive, status).  Here a
batch of files is one DataFrame: records are built by one ``select``, appended once per table,
and every file gets a status row.  A file that cannot be processed becomes a ``failed`` status row
instead of failing the job.  The pure part (``*_plan``) has no side effect and is what the
registered queries run; ``ingest_files`` adds the appends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as TX
from ..operators import chunk as CH
from ..operators import records as RC
from ..operators import vectors as VC
from ..sources import listing as LS
from ..sources import tables as TB
from ..session import reliable_checkpoint


def _status(file_id: Column, filename: Column, failed_reason: Column, ok_message: str, run_ts: Column) -> list[Column]:
    failed = failed_reason.isNotNull()
    return [
        F.when(failed, F.lit("")).otherwise(file_id).alias("file_id"),
        filename.alias("filename"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
        F.when(failed, F.concat(F.lit("Processing error: "), failed_reason)).otherwise(F.lit(ok_message)).alias("message"),
        F.when(failed, F.lit(None).cast("timestamp_ntz")).otherwise(run_ts.cast("timestamp_ntz")).alias("processed_at"),
    ]


#: What tells one version of a staged file from another; carried through a plan where the files have it.
IDENTITY = ("path", "modificationTime", "length")


def _identity(files: DataFrame) -> list[str]:
    return [c for c in IDENTITY if c in files.columns]


def txt_ingest_plan(files: DataFrame, run_ts: Column, run_epoch: Column | None = None, reject_empty: bool = False) -> DataFrame:
    """T12 for a batch: ``files(object_name, content)`` -> record columns + ``_status``.
    Unreadable (null) and, with ``reject_empty``, empty files fail; any other bytes decode."""
    f = files.withColumn("filename", TX.basename("object_name")).withColumn("upload_datetime", run_ts.cast("timestamp_ntz"))
    empty = F.when(F.octet_length("content") == 0, F.lit(S.MSG_FILE_EMPTY)) if reject_empty else F.lit(None)
    reason = F.when(F.col("content").isNull(), F.lit("unreadable file")).otherwise(empty)
    rec = f.select(
        *RC.txt_record_columns(run_epoch), reason.alias("_reason"), "object_name", F.col("content").alias("_bytes"), *_identity(files)
    )
    st = _status(F.col("file_id"), F.col("source_file"), F.col("_reason"), S.MSG_TXT_OK, run_ts)
    return rec.select("*", F.struct(*st).alias("_status"))


def pdf_ingest_plan(extracted: DataFrame, run_ts: Column, run_epoch: Column | None = None) -> DataFrame:
    """T11 for a batch: ``extracted(object_name, file_size, text, page_count, error,
    summarize_details)`` -> record columns + ``_status`` + ``vectorized`` (a summary exists to be
    vectorised; reported as its own column instead of failing a file whose row is stored).
    An extraction error fails the file."""
    f = extracted.withColumn("filename", TX.basename("object_name")).withColumn("upload_datetime", run_ts.cast("timestamp_ntz"))
    f = f.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    rec = f.select(
        *RC.pdf_record_columns(run_epoch),
        F.col("text").alias("_text"),
        F.col("error").alias("_reason"),
        "object_name",
        (F.col("content") if "content" in f.columns else F.lit(None).cast("binary")).alias("_bytes"),
        F.col("summarize_details").isNotNull().alias("vectorized"),
        *_identity(extracted),
    )
    st = _status(F.col("file_id"), F.col("source_file"), F.col("_reason"), S.MSG_PDF_OK, run_ts)
    return rec.select("*", F.struct(*st).alias("_status"))


def status_rows(plan: DataFrame, file_type: str | None = None, with_object: bool = False) -> DataFrame:
    cols = [F.col("_status.*")]
    if with_object:
        cols += [F.col("object_name"), *map(F.col, _identity(plan))]
    if file_type is not None:
        cols.append(F.lit(file_type).alias("file_type"))
    if "vectorized" in plan.columns:
        cols.append(F.col("vectorized"))
    return plan.select(*cols)


def record_rows(plan: DataFrame, table: str) -> DataFrame:
    """Records of the files that did not fail, in the table's column order."""
    schema = S.TABLE_SCHEMAS[table]
    ok = plan.where(F.col("_status.status") == "completed")
    return ok.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def batch_summary(status: DataFrame) -> DataFrame:
    """A2: total_processed, success_count, error_count, pdf_count, txt_count (one pass)."""
    return status.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("status") == "completed").alias("success_count"),
        F.count_if(F.col("status") != "completed").alias("error_count"),
        F.count_if(F.col("file_type") == "pdf").alias("pdf_count"),
        F.count_if(F.col("file_type") == "txt").alias("txt_count"),
    )


def batch_summary_by_type(status: DataFrame) -> DataFrame:
    """A3: the same counts per file type."""
    return status.groupBy("file_type").agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("status") == "completed").alias("success_count"),
        F.count_if(F.col("status") != "completed").alias("error_count"),
    )


# ---------------------------------------------------------------------------------------------
# Jobs (side effects: table appends, silver text, points)
# ---------------------------------------------------------------------------------------------

Extractor = Callable[[bytes], tuple]
SILVER_BUCKETS = 64


def utf8_text_extractor(data: bytes) -> tuple[str, int]:
    """Default stand-in extractor for text-bearing files (no PDF parser is bundled)."""
    if data is None:
        raise ValueError("no bytes")
    return data.decode("utf-8"), 1


def quarantined(plan: DataFrame) -> DataFrame:
    """(object_name, reason, content) of the files that failed, with their bytes."""
    return plan.where(F.col("_status.status") == "failed").select(
        "object_name", F.col("_status.message").alias("reason"), F.col("_bytes").alias("content")
    )


def ingest_files(
    files: DataFrame,
    file_type: str,
    warehouse: str,
    run_ts: str,
    extractor: Extractor = utf8_text_extractor,
    summarizer: Callable[[str], str | None] | None = None,
    embedder: VC.Embedder | None = None,
    collection: str | None = None,
    run_id: str | None = None,
    batch_id: int = 0,
) -> DataFrame:
    """Process one batch of staged files (object_name, content) of one type; returns a status row per file.

    Records are appended once for the batch (see ``append_documents``), a PDF's text goes to the silver table,
    and with an embedder a PDF's summary is vectorized into ``collection``: ``vectorized`` says whether points of
    it were written.  Files that fail, empty ones among them, are copied with their bytes to
    ``{warehouse}/quarantine`` before the batch ends, into a partition of this run (a new one unless named) and
    batch, so no other batch's files are overwritten.  ``files`` may carry path, modificationTime and length; the
    status rows then have them, too."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    files = files.select("object_name", "content", *_identity(files))
    if file_type == "txt":
        plan = txt_ingest_plan(files, ts, reject_empty=True)
        table = S.TXT_TABLE
    elif file_type == "pdf":
        ext = RC.extract_with(files.withColumn("file_size", F.octet_length("content")), extractor)
        ext = ext.withColumn("error", F.when(F.col("file_size") == 0, F.lit(S.MSG_FILE_EMPTY)).otherwise(F.col("error")))
        if summarizer is not None:
            ext = RC.summarize_with(ext, summarizer)
        else:
            ext = ext.withColumn("summarize_details", F.lit(None).cast("string"))
        plan = pdf_ingest_plan(ext, ts)
        table = S.PDF_TABLE
    else:
        raise ValueError(S.MSG_BAD_TYPE)
    plan = reliable_checkpoint(plan)  # extraction runs once even if an executor is lost later
    keys = {"file_type": F.lit(file_type), "run_id": F.lit(run_id or uuid.uuid4().hex), "batch_id": F.lit(batch_id).cast("long")}
    bad = quarantined(plan).withColumn("run_ts", F.lit(run_ts)).withColumns(keys)
    if not bad.isEmpty():
        (
            bad.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(warehouse.rstrip("/") + "/quarantine")
        )
    TB.append_documents(record_rows(plan, table), warehouse, table)
    if file_type == "pdf":
        done = plan.where(F.col("_status.status") == "completed")
        save_silver(
            done.select(F.col("content").alias("path"), F.col("_text").alias("text"), "upload_datetime", "object_name"), warehouse
        )
        if embedder is not None and collection is not None:
            source = done.where(F.col("summarize_details").isNotNull()).select("content", "summarize_details")
            points = reliable_checkpoint(vectorize(source, "summarize_details", "content", embedder, run_ts, kind="summary"))
            VC.save_points(points, collection)
            written = points.select(F.col("source").alias("content"), F.lit(True).alias("_written")).distinct()
            plan = plan.drop("vectorized").join(written, "content", "left")
            plan = plan.withColumn("vectorized", F.coalesce("_written", F.lit(False)) & (F.col("_status.status") == "completed"))
        else:
            plan = plan.withColumn("vectorized", F.lit(False))
    return status_rows(plan, file_type, with_object=True)


def newest_silver(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Per silver path the text of the latest upload (ties: the last object name); columns of ``existing``."""
    last = Window.partitionBy("path").orderBy(F.desc("upload_datetime"), F.desc("object_name"))
    every = existing.unionByName(new)
    return every.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def save_silver(silver: DataFrame, warehouse: str) -> None:
    """W4 on storage: (path, text, upload_datetime, object_name) by hash bucket of the path.  A file uploaded
    again shows its new text; only the buckets of the batch's paths are written anew, from a copy in the shared
    folder."""
    spark = silver.sparkSession
    location = warehouse.rstrip("/") + "/silver_documents"
    new = silver.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(SILVER_BUCKETS)).cast("int"))
    held = new.limit(0)
    if TB.table_exists(spark, warehouse, "silver_documents"):
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most SILVER_BUCKETS
        held = spark.read.schema(new.schema).parquet(location).where(F.col("bucket").isin(touched))
    merged = reliable_checkpoint(newest_silver(held, new))
    (
        merged.hint("rebalance", "bucket").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(location)
    )


def read_staged(spark: SparkSession, staging_root: str, file_type: str) -> DataFrame:
    """Staged objects of one type as ``(object_name, content)``."""
    objs = LS.read_objects(spark, staging_root, f"{file_type}s")
    return objs.select(F.col("name").alias("object_name"), "content")


def vectorize(
    points_source: DataFrame, text_col: str, key_col: str, embedder, run_ts: str, dim: int | None = None, kind: str = "file"
) -> DataFrame:
    """T5/T6 as one plan: chunk -> embed -> points keyed by ``key_col`` (the source path) and ``kind`` (the file's
    text or its summary)."""
    ch = CH.chunk_text(points_source.select(key_col, text_col), text_col, [key_col])
    emb = reliable_checkpoint(VC.embed_chunks(ch, embedder))  # never call the embedder twice
    pts = VC.build_points(emb, F.col(key_col), upload_ts=F.lit(run_ts).cast("timestamp_ntz"), kind=kind)
    return VC.check_dimension(pts, dim) if dim else pts
