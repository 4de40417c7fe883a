"""Staged files -> typed document records.

Each record builder is one ``select`` over a DataFrame of files, so a whole batch becomes one
DataFrame and one append.  Ids are deterministic (F9), so a retried task or a re-run yields the
same ids and the append can skip rows already present.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import decode as DC
from ..functions import text as TX


def upload_month(ts: Column) -> Column:
    """Month partition value of ``upload_datetime`` (the reference's month transform)."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 7)


def txt_record_columns(run_epoch: Column | None = None) -> list[Column]:
    """T7 as column expressions over ``(filename, content bytes, upload_datetime)``: F10-decoded
    content, MD5 content hash, title from the file name, byte size, version 1."""
    epoch = run_epoch if run_epoch is not None else TX.epoch_seconds("upload_datetime")
    dec = DC.decode_bytes("content")
    return [
        TX.document_id("txt", F.sha2("content", 256), epoch).alias("file_id"),
        F.col("upload_datetime").cast("timestamp_ntz").alias("upload_datetime"),
        TX.title_from_filename("filename").alias("title"),
        dec["text"].alias("content"),
        F.col("filename").alias("source_file"),
        F.lit(None).cast("string").alias("source_link"),
        F.octet_length("content").cast("long").alias("file_size"),
        F.lit(1).alias("version"),
        F.md5("content").alias("content_hash"),
    ]


def txt_records(files: DataFrame, run_epoch: Column | None = None) -> DataFrame:
    """Files -> ``txt_documents`` rows (one select for the whole batch)."""
    return files.select(*txt_record_columns(run_epoch))


def decode_and_clean(files: DataFrame) -> DataFrame:
    """T10 (older TXT path): decode by the cascade, then F1 clean; keeps the encoding used."""
    dec = DC.decode_bytes("content")
    return files.select(
        *[c for c in files.columns if c != "content"],
        dec["encoding"].alias("encoding"),
        TX.clean_text(dec["text"]).alias("content"),
    )


def txt_records_legacy(files: DataFrame, epoch: Column) -> DataFrame:
    """Older TXT record: cleaned content, title from content else the file name without
    ``.txt``, source link from the cleaned content, SHA-256 hash and id."""
    pre = files.withColumn("_sha", F.sha2("content", 256)).withColumn("file_size", F.octet_length("content").cast("long"))
    cleaned = decode_and_clean(pre)
    sha = F.col("_sha")
    return cleaned.select(
        TX.document_id("txt", sha, epoch).alias("file_id"),
        F.col("upload_datetime").cast("timestamp_ntz").alias("upload_datetime"),
        F.coalesce(TX.title_from_content("content"), F.replace(F.col("filename"), F.lit(".txt"), F.lit(""))).alias("title"),
        "content",
        F.col("filename").alias("source_file"),
        TX.source_link("content").alias("source_link"),
        F.col("file_size"),
        sha.alias("content_hash"),
        F.lit(1).alias("version"),
    )


def silver_path(filename: Column, bucket: str = "silver") -> Column:
    """Where extracted markdown of a PDF lives: ``{bucket}/pdfs/{stem}.md``."""
    stem = F.regexp_replace(filename, r"\.[^.]*$", "")
    return F.concat(F.lit(f"{bucket}/pdfs/"), stem, F.lit(".md"))


def pdf_record_columns(run_epoch: Column | None = None) -> list[Column]:
    """T8 as column expressions over ``(filename, text, page_count, summarize_details, file_size,
    upload_datetime)``.  ``content`` holds the silver path (table contract); page_count defaults
    to 1."""
    epoch = run_epoch if run_epoch is not None else TX.epoch_seconds("upload_datetime")
    return [
        TX.document_id("pdf", F.sha2("text", 256), epoch).alias("file_id"),
        F.col("upload_datetime").cast("timestamp_ntz").alias("upload_datetime"),
        TX.title_from_filename("filename").alias("title"),
        F.col("summarize_details"),
        silver_path(F.col("filename")).alias("content"),
        F.col("filename").alias("source_file"),
        F.col("file_size").cast("long").alias("file_size"),
        F.coalesce(F.col("page_count"), F.lit(1)).cast("int").alias("page_count"),
        F.lit(1).alias("version"),
        F.md5("text").alias("content_hash"),
    ]


def pdf_records(extracted: DataFrame, run_epoch: Column | None = None) -> DataFrame:
    """Extracted PDFs -> ``pdf_documents`` rows."""
    return extracted.select(*pdf_record_columns(run_epoch))


def extraction_fallback(primary: Column, secondary: Column, failed: Column | None = None) -> Column:
    """Primary text; if blank the secondary; if still blank a marker; an extraction error gives
    the error marker.  Then F1 clean."""
    def usable(c: Column) -> Column:
        return F.when(F.length(TX.py_strip(c)) > 0, c)

    chosen = F.coalesce(usable(primary), usable(secondary), F.lit(S.NO_TEXT_FOUND))
    if failed is not None:
        chosen = F.when(failed, F.lit(S.EXTRACTION_ERROR)).otherwise(chosen)
    return TX.clean_text(chosen)


def pdf_records_legacy(extracted: DataFrame, epoch: Column) -> DataFrame:
    """T8, older PDF record over (filename, content bytes, text, page_count, upload_datetime): the cleaned text
    is the content, title from it else the file name without ``.pdf``, SHA-256 hash and id of the bytes, no
    pages where they cannot be counted."""
    sha = F.sha2("content", 256)
    base = extracted.select(
        TX.document_id("pdf", sha, epoch).alias("file_id"),
        F.col("upload_datetime").cast("timestamp_ntz").alias("upload_datetime"),
        TX.clean_text("text").alias("_cleaned"),
        F.col("filename").alias("source_file"),
        F.octet_length("content").cast("long").alias("file_size"),
        sha.alias("content_hash"),
        F.coalesce("page_count", F.lit(0)).cast("int").alias("page_count"),
    )
    title = F.coalesce(TX.title_from_content("_cleaned"), F.replace(F.col("source_file"), F.lit(".pdf"), F.lit("")))
    return base.select(
        "file_id", "upload_datetime", title.alias("title"), F.col("_cleaned").alias("content"), "source_file", "file_size",
        "content_hash", "page_count", F.lit(1).alias("version"),
    )


def summarize_with(df: DataFrame, summarizer: Callable[[str], str | None], text_col: str = "text") -> DataFrame:
    """Adds ``summarize_details`` by a pluggable summarizer, in Arrow batches; a text that fails (or is null) has
    a null summary and the job goes on."""

    @F.pandas_udf("string")
    def summary(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return None if text is None else summarizer(text)
            except Exception:  # noqa: BLE001 - isolate per text
                return None

        return texts.map(one).astype(object)

    return df.withColumn("summarize_details", summary(F.col(text_col)))


EXTRACTED = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)


def extract_with(files: DataFrame, extractor: Callable[[bytes], tuple[str | None, int | None]], content_col: str = "content") -> DataFrame:
    """Run a pluggable extractor (bytes -> (text, page_count)) over file bytes in Arrow batches.
    A failing file yields ``error`` (and null text), never a failed job."""
    out_schema = T.StructType([f for f in files.schema.fields] + list(EXTRACTED.fields))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, pages, errors = [], [], []
            for b in pdf[content_col].tolist():
                try:
                    t, n = extractor(None if b is None else bytes(b))
                    texts.append(t)
                    pages.append(n)
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001 - isolate per file
                    texts.append(None)
                    pages.append(0)
                    errors.append(f"{type(exc).__name__}: {exc}")
            pdf = pdf.copy()
            pdf["text"] = texts
            pdf["page_count"] = pd.array(pages, dtype="Int32")
            pdf["error"] = errors
            yield pdf

    return files.mapInPandas(run, out_schema)


PAGES = [
    T.StructField("page_no", T.IntegerType()),
    T.StructField("page_text", T.StringType()),
    T.StructField("page_error", T.StringType()),
]
PAGES_AT_ONCE = 1000


def extract_pages(files: DataFrame, paginate: Callable[[bytes], list], read_page: Callable[[object], str | None], content_col: str = "content") -> DataFrame:
    """T9 page by page: one row for each page of each file: the files' columns without the bytes, ``page_no`` (from
    1), ``page_text`` and ``page_error``.

    ``paginate`` gives a file's pages (any objects), ``read_page`` the text of one.  A page that fails costs that
    page; a file whose ``paginate`` fails, or that has no pages, is one row with page_no 0.  A file's rows leave the
    task as they are read, PAGES_AT_ONCE at a time, so a file of any number of pages is never held as a frame."""
    keep = [f for f in files.schema.fields if f.name != content_col]
    schema = T.StructType(keep + PAGES)

    def pages(data) -> Iterator[tuple[int, str | None, str | None]]:
        try:
            own = paginate(None if data is None else bytes(data))
        except Exception as exc:  # noqa: BLE001 - isolate per file
            yield 0, None, f"{type(exc).__name__}: {exc}"
            return
        n = 0
        for n, page in enumerate(own, 1):
            try:
                yield n, read_page(page), None
            except Exception as exc:  # noqa: BLE001 - isolate per page
                yield n, None, f"{type(exc).__name__}: {exc}"
        if not n:
            yield 0, None, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.name for f in keep]
        for pdf in batches:
            rows: list[tuple] = []
            for own, data in zip(pdf[names].itertuples(index=False, name=None), pdf[content_col], strict=True):
                for page in pages(data):
                    rows.append((*own, *page))
                    if len(rows) == PAGES_AT_ONCE:
                        yield pd.DataFrame(rows, columns=schema.names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=schema.names)

    return files.mapInPandas(run, schema)


def join_pages(pages: DataFrame, key: str) -> DataFrame:
    """(key, text, page_count, failed_pages, error) for each file of ``extract_pages`` rows: its page texts in order,
    joined by a blank line; pages without text (and failed ones) are left out but counted.  A file that could not be
    opened has its error and 0 pages, one whose pages all failed the first page's error.  T9's fallback and marker
    follow on ``text``."""
    some = F.when(F.col("page_text") != "", F.col("page_text"))
    bad = F.col("page_error").isNotNull()
    held = pages.withColumns({"_some": some, "_bad": bad, "_real": F.col("page_no") > 0})
    return held.groupBy(key).agg(
        F.coalesce(F.expr("listagg(_some, '\n\n') WITHIN GROUP (ORDER BY page_no)"), F.lit("")).alias("text"),
        F.count_if("_real").cast("int").alias("page_count"),
        F.count_if(F.col("_real") & F.col("_bad")).cast("int").alias("failed_pages"),
        F.min(F.when(F.col("_bad"), F.struct("page_no", "page_error"))).alias("_first"),
        F.count_if(~F.col("_bad")).alias("_good"),
    ).select(key, "text", "page_count", "failed_pages", F.when(F.col("_good") == 0, F.col("_first.page_error")).alias("error"))
