"""Fixture views: the reference's table contracts, derived from the driver's tables.

Each view is a lazy DataFrame over ``documents`` / ``embeddings`` (so its work grows with them),
with a DuckDB twin (``sql_with``) used by the SQL oracle.  Definitions follow FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as TX
from .session import spread, table_path

EPOCH_2024 = 1704067200


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(table_path(sf_dir, name)))


def staged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    file_type = F.when(F.col("doc_id") % 3 == 0, F.lit("pdf")).otherwise(F.lit("txt"))
    hours = F.col("doc_id")
    upload_dt = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        (hours / 24).cast("long").cast("int"), (hours % 24).cast("int")
    )
    return (
        d.select("doc_id", "source", "lang", "text", "n_chars")
        .withColumn("file_type", file_type)
        .withColumn(
            "filename",
            F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("-"), F.col("source"), F.lit(".v1."), F.col("file_type")),
        )
        .withColumn("object_name", F.concat(F.col("file_type"), F.lit("s/"), F.col("filename")))
        .withColumn("file_size", F.octet_length("text").cast("long"))
        .withColumn("upload_epoch", (F.lit(EPOCH_2024) + F.col("doc_id") * 3600).cast("long"))
        .withColumn("upload_datetime", upload_dt)
        .withColumn("content", F.encode("text", "UTF-8"))
    )


def summary_of(text: str, lang: str) -> Column:
    """A stand-in summary made from the whole text; one language has none."""
    return F.when(F.col(lang) != "es", F.concat(F.lit("Summary. "), F.col(text)))


def pdf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    return s.select(
        TX.document_id("pdf", F.sha2("text", 256), "upload_epoch").alias("file_id"),
        "upload_datetime",
        TX.title_from_filename("filename").alias("title"),
        summary_of("text", "lang").alias("summarize_details"),
        F.concat(F.lit("silver/pdfs/"), F.expr("substr(filename, 1, length(filename) - 4)"), F.lit(".md")).alias("content"),
        F.col("filename").alias("source_file"),
        "file_size",
        F.ceil(F.col("n_chars") / F.lit(3000.0)).cast("int").alias("page_count"),
        F.lit(1).alias("version"),
        F.md5("text").alias("content_hash"),
    )


def txt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staged_files(spark, sf_dir).where(F.col("file_type") == "txt")
    return s.select(
        TX.document_id("txt", F.sha2("text", 256), "upload_epoch").alias("file_id"),
        "upload_datetime",
        TX.title_from_filename("filename").alias("title"),
        F.col("text").alias("content"),
        F.col("filename").alias("source_file"),
        F.lit(None).cast("string").alias("source_link"),
        "file_size",
        F.lit(1).alias("version"),
        F.md5("text").alias("content_hash"),
    )


def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    return s.select(
        F.concat(F.lit("silver/pdfs/"), F.expr("substr(filename, 1, length(filename) - 4)"), F.lit(".md")).alias("path"),
        "text",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    return e.select(
        F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("point_id"),
        "vec_id",
        F.concat(F.lit("silver/pdfs/doc_"), (F.col("vec_id") - F.col("vec_id") % 7).cast("string"), F.lit(".md")).alias("source"),
        (F.col("vec_id") % 7).cast("int").alias("chunk_index"),
        F.when(F.col("vec_id") % 50 == 49, F.lit(None)).otherwise(F.col("embedding")).alias("embedding"),
        "label",
    )


def upload_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload requests: by ``doc_id % 10``: 0 empty body, 1 wrong extension, 2 already staged,
    otherwise a new valid file."""
    s = staged_files(spark, sf_dir)
    k = F.col("doc_id") % 10
    stem = F.expr("substr(filename, 1, length(filename) - 4)")
    name = (
        F.when(k == 2, F.col("filename"))
        .when(k == 1, F.concat(F.lit("new_"), stem, F.lit(".docx")))
        .otherwise(F.concat(F.lit("new_"), F.col("filename")))
    )
    body = F.when(k == 0, F.lit(b"")).otherwise(F.col("content"))
    return s.select("doc_id", "file_type", name.alias("filename"), body.alias("content"))


# ---------------------------------------------------------------------------------------------
# DuckDB twins of the views above (for the SQL oracle).  Spelled out once, composed per query.
# ---------------------------------------------------------------------------------------------

_TITLE_SQL = (
    "array_to_string(list_transform(regexp_extract_all(translate(regexp_replace({x}, '\\.[^.]*$', ''), '_-', '  '), "
    "'([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)', 1), lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')"
)


def title_sql(x: str) -> str:
    return _TITLE_SQL.format(x=x)


SQL_VIEWS = {
    "staged_files": f"""
  SELECT doc_id, source, lang, text, n_chars, file_type,
         'doc_' || doc_id || '-' || source || '.v1.' || file_type AS filename,
         file_type || 's/' || 'doc_' || doc_id || '-' || source || '.v1.' || file_type AS object_name,
         CAST(strlen(text) AS BIGINT) AS file_size,
         CAST({EPOCH_2024} + doc_id * 3600 AS BIGINT) AS upload_epoch,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS upload_datetime,
         encode(text) AS content
  FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'pdf' ELSE 'txt' END AS file_type FROM documents) d""",
    "pdf_documents": f"""
  SELECT 'pdf_' || substr(sha256(text), 1, 16) || '_' || upload_epoch AS file_id,
         upload_datetime,
         {title_sql('filename')} AS title,
         CASE WHEN lang <> 'es' THEN 'Summary. ' || text END AS summarize_details,
         'silver/pdfs/' || substr(filename, 1, length(filename) - 4) || '.md' AS content,
         filename AS source_file, file_size,
         CAST(ceil(n_chars / 3000.0) AS INTEGER) AS page_count,
         1 AS version, md5(text) AS content_hash
  FROM staged_files WHERE file_type = 'pdf'""",
    "txt_documents": f"""
  SELECT 'txt_' || substr(sha256(text), 1, 16) || '_' || upload_epoch AS file_id,
         upload_datetime,
         {title_sql('filename')} AS title,
         text AS content, filename AS source_file, CAST(NULL AS VARCHAR) AS source_link,
         file_size, 1 AS version, md5(text) AS content_hash
  FROM staged_files WHERE file_type = 'txt'""",
    "silver_documents": """
  SELECT 'silver/pdfs/' || substr(filename, 1, length(filename) - 4) || '.md' AS path, text
  FROM staged_files WHERE file_type = 'pdf'""",
    "points": """
  SELECT 'p' || vec_id AS point_id, vec_id,
         'silver/pdfs/doc_' || (vec_id - vec_id % 7) || '.md' AS source,
         CAST(vec_id % 7 AS INTEGER) AS chunk_index,
         CASE WHEN vec_id % 50 = 49 THEN NULL ELSE embedding END AS embedding, label
  FROM embeddings""",
    "upload_candidates": """
  SELECT doc_id, file_type,
         CASE WHEN doc_id % 10 = 2 THEN filename
              WHEN doc_id % 10 = 1 THEN 'new_' || substr(filename, 1, length(filename) - 4) || '.docx'
              ELSE 'new_' || filename END AS filename,
         CASE WHEN doc_id % 10 = 0 THEN ''::BLOB ELSE content END AS content
  FROM staged_files""",
}

_DEPENDS = {
    "staged_files": [],
    "pdf_documents": ["staged_files"],
    "txt_documents": ["staged_files"],
    "silver_documents": ["staged_files"],
    "points": [],
    "upload_candidates": ["staged_files"],
}


def sql_with(*views: str, recursive: bool = False, extra: str = "") -> str:
    """``WITH`` clause defining the requested fixture views (dependencies first); ``extra`` adds
    further comma-separated CTEs after them."""
    ordered: list[str] = []

    def add(v: str) -> None:
        for dep in _DEPENDS[v]:
            add(dep)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    parts = [f"{v} AS ({SQL_VIEWS[v]}\n)" for v in ordered] + ([extra] if extra else [])
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"
