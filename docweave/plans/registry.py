"""Registered queries: one Spark plan and, where SQL can say it, one DuckDB oracle per key.

Every query reads the driver's tables (through the fixture views) in full.  ``QUERIES[key]`` takes
``(spark, sf_dir)`` and returns a lazy DataFrame; ``ORACLE[key]`` is the same result in SQL.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as FX
from .. import schemas as S
from ..functions import text as TX
from ..operators import search as SR
from ..session import ensure_checkpoint_dir

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


# DuckDB spellings of the Python character classes (RE2 has no Unicode \s).
SQL_WS = r"[\t\n\x0b\x0c\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL_NONWS = SQL_WS.replace("[", "[^", 1)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_lstrip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+', '')"


_URL = f"https?://{SQL_NONWS}+"


def sql_clean(x: str) -> str:
    """F1 over column ``x``."""
    return f"coalesce(regexp_replace(trim(regexp_replace({x}, '{SQL_WS}+', ' ', 'g')), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g'), '')"


def sql_title_from_content(x: str, h: str) -> str:
    """F3 over column ``x``; ``h`` is a column holding ``left(lstrip(x), 100)``."""
    cut = (
        f"CASE WHEN strpos({h}, '.') > 0 THEN split_part({h}, '.', 1) || '.' "
        f"WHEN strpos({h}, chr(10)) > 0 THEN split_part({h}, chr(10), 1) ELSE {h} END"
    )
    return f"""CASE WHEN {x} IS NULL OR {sql_lstrip(x)} = '' THEN NULL
       ELSE coalesce(
         list_filter(list_transform(string_split({x}, chr(10))[1:5], lambda x: {sql_strip('x')}),
                     lambda x: length(x) > 5 AND length(x) <= 100
                       AND NOT regexp_matches(lower(x), 'created:|modified:|author:|date:|source:|url:'))[1],
         nullif({sql_strip(cut)}, ''))
  END"""


def sql_source_link(x: str) -> str:
    """F6 over column ``x``."""
    return f"""nullif(regexp_extract(
  list_filter(list_transform(string_split({x}, chr(10))[1:10], lambda x: lower({sql_strip('x')})),
              lambda x: regexp_matches(x, 'source:|url:|link:|from:') AND regexp_matches(x, '{_URL}'))[1], '{_URL}', 0), '')"""


def _doc_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {S.PDF_TABLE: FX.pdf_documents(spark, sf_dir), S.TXT_TABLE: FX.txt_documents(spark, sf_dir)}


# ---------------------------------------------------------------------------------------------
# Q1 content search
# ---------------------------------------------------------------------------------------------

SEARCH_QUERY = "RÉ(EAU|OU)"


@register(
    "search_documents",
    FX.sql_with("pdf_documents", "txt_documents")
    + f"""
SELECT * EXCLUDE (_ord) FROM (
  SELECT *, 'pdf_documents' AS source_table, 0 AS _ord FROM pdf_documents WHERE regexp_matches(content, '{SEARCH_QUERY}', 'i')
  UNION ALL BY NAME
  SELECT *, 'txt_documents' AS source_table, 1 AS _ord FROM txt_documents WHERE regexp_matches(content, '{SEARCH_QUERY}', 'i')
) ORDER BY _ord, upload_datetime, file_id, source_file LIMIT 10""",
)
def q_search_documents(spark, sf_dir):
    return SR.search_documents(_doc_tables(spark, sf_dir), SEARCH_QUERY, limit=S.DEFAULT_LIMIT)


PATH_QUERY = "SRC1[0-9]"


@register(
    "search_documents_paths",
    FX.sql_with("pdf_documents", "txt_documents")
    + f"""
SELECT * EXCLUDE (_ord) FROM (
  SELECT *, 'pdf_documents' AS source_table, 0 AS _ord FROM pdf_documents WHERE regexp_matches(content, '{PATH_QUERY}', 'i')
  UNION ALL BY NAME
  SELECT *, 'txt_documents' AS source_table, 1 AS _ord FROM txt_documents WHERE regexp_matches(content, '{PATH_QUERY}', 'i')
) ORDER BY _ord, upload_datetime, file_id, source_file LIMIT 25""",
)
def q_search_documents_paths(spark, sf_dir):
    # PDF rows hold the silver path in ``content`` (kept as in the table contract), so a pattern
    # over paths finds PDF rows; the limit here spans both tables.
    return SR.search_documents(_doc_tables(spark, sf_dir), PATH_QUERY, limit=25)


# ---------------------------------------------------------------------------------------------
# F1-F12, P5 text functions
# ---------------------------------------------------------------------------------------------


@register("clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def q_clean_text(spark, sf_dir):
    return FX.load(spark, sf_dir, "documents").select("doc_id", TX.clean_text("text").alias("cleaned"))


@register(
    "title_from_filename",
    FX.sql_with("staged_files") + f"SELECT doc_id, filename, {FX.title_sql('filename')} AS title FROM staged_files",
)
def q_title_from_filename(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir)
    return s.select("doc_id", "filename", TX.title_from_filename("filename").alias("title"))


@register(
    "title_from_content",
    f"SELECT doc_id, {sql_title_from_content('text', 'h')} AS title FROM (SELECT doc_id, text, left({sql_lstrip('text')}, 100) AS h FROM documents)",
)
def q_title_from_content(spark, sf_dir):
    d = FX.load(spark, sf_dir, "documents")
    return d.select("doc_id", TX.title_from_content("text").alias("title"))


@register(
    "truncate_text",
    """
SELECT doc_id,
  CASE WHEN length(text) <= 1000 THEN text
       ELSE (CASE WHEN sp > 800 THEN left(h, sp) ELSE h END) || '...' END AS truncated
FROM (SELECT doc_id, text, h,
             CASE WHEN strpos(h, ' ') = 0 THEN -1 ELSE length(regexp_extract(h, '(?s)^(.*) ', 1)) END AS sp
      FROM (SELECT doc_id, text, left(text, 1000) AS h FROM documents))""",
)
def q_truncate_text(spark, sf_dir):
    d = FX.load(spark, sf_dir, "documents")
    return d.select("doc_id", TX.truncate_text("text").alias("truncated"))


def _crawled_pages(spark, sf_dir):
    # Crawled pages as saved text files: a "Source:" header line, then the page.
    p = FX.load(spark, sf_dir, "pages")
    return p.select("page_id", F.concat(F.lit("Source: "), F.col("url"), F.lit("\n"), F.col("html")).alias("text"))


@register(
    "source_link",
    f"SELECT page_id, {sql_source_link('text')} AS source_link FROM (SELECT page_id, 'Source: ' || url || chr(10) || html AS text FROM pages)",
)
def q_source_link(spark, sf_dir):
    return _crawled_pages(spark, sf_dir).select("page_id", TX.source_link("text").alias("source_link"))


@register("source_link_documents", f"SELECT doc_id, {sql_source_link('text')} AS source_link FROM documents")
def q_source_link_documents(spark, sf_dir):
    d = FX.load(spark, sf_dir, "documents")
    return d.select("doc_id", TX.source_link("text").alias("source_link"))


@register("content_hash_md5", FX.sql_with("staged_files") + "SELECT doc_id, md5(content) AS content_hash FROM staged_files")
def q_md5(spark, sf_dir):
    return FX.staged_files(spark, sf_dir).select("doc_id", TX.content_md5("content").alias("content_hash"))


@register(
    "content_hash_sha256", FX.sql_with("staged_files") + "SELECT doc_id, sha256(content) AS content_hash FROM staged_files"
)
def q_sha256(spark, sf_dir):
    return FX.staged_files(spark, sf_dir).select("doc_id", TX.content_sha256("content").alias("content_hash"))


@register(
    "document_id",
    FX.sql_with("staged_files")
    + "SELECT doc_id, file_type || '_' || substr(sha256(content), 1, 16) || '_' || upload_epoch AS file_id FROM staged_files",
)
def q_document_id(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir)
    sha = TX.content_sha256("content")
    fid = F.when(F.col("file_type") == "pdf", TX.document_id("pdf", sha, "upload_epoch")).otherwise(
        TX.document_id("txt", sha, "upload_epoch")
    )
    return s.select("doc_id", fid.alias("file_id"))


@register(
    "path_split",
    FX.sql_with("pdf_documents")
    + """
SELECT file_id, split_part(content, '/', 1) AS bucket, regexp_extract(content, '^[^/]*/?(.*)$', 1) AS object_key,
       regexp_extract(content, '[^/]*$', 0) AS basename
FROM pdf_documents""",
)
def q_path_split(spark, sf_dir):
    p = FX.pdf_documents(spark, sf_dir)
    bucket, key = TX.split_bucket_key("content")
    return p.select("file_id", bucket.alias("bucket"), key.alias("object_key"), TX.basename("content").alias("basename"))


@register(
    "local_time",
    FX.sql_with("staged_files")
    + """
SELECT doc_id, strftime(upload_datetime + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time,
       strftime(upload_datetime + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS local_iso
FROM staged_files""",
)
def q_local_time(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir)
    return s.select("doc_id", TX.local_time("upload_datetime").alias("local_time"), TX.local_iso("upload_datetime").alias("local_iso"))


_NONPRINT_SQL = r"[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\xad\x{0600}-\x{0605}\x{061c}\x{06dd}\x{070f}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{2066}-\x{206f}\x{feff}\x{fff9}-\x{fffb}\x{e000}-\x{f8ff}]"


@register(
    "validate_text_content",
    f"""
SELECT doc_id, reason IS NULL AS ok, reason FROM (
  SELECT doc_id,
    CASE WHEN text IS NULL OR length({sql_strip('text')}) = 0 THEN 'Text content is empty'
         WHEN length({sql_strip('text')}) < 10 THEN 'Text content is too short (minimum 10 characters)'
         WHEN (length(text) - (length(text) - length(regexp_replace(text, '{_NONPRINT_SQL}', '', 'g')))) / length(text) < 0.8
           THEN 'Text contains too many non-printable characters'
    END AS reason
  FROM documents)""",
)
def q_validate_text_content(spark, sf_dir):
    d = FX.load(spark, sf_dir, "documents")
    v = TX.validate_text_content("text")
    return d.select("doc_id", v["ok"].alias("ok"), v["reason"].alias("reason"))


# ---------------------------------------------------------------------------------------------
# T1/T2 chunking, F4/A6 keywords
# ---------------------------------------------------------------------------------------------

from ..operators import chunk as CH  # noqa: E402
from ..operators import keywords as KW  # noqa: E402


def _last_sql(w: str, ch: str) -> str:
    esc = "\\." if ch == "." else ch
    return f"(CASE WHEN strpos({w}, '{ch}') = 0 THEN -1 ELSE length(regexp_extract({w}, '(?s)^(.*){esc}', 1)) END)"


def chunk_sql(source: str, key: str, text: str, size: int = S.CHUNK_SIZE, overlap: int = S.CHUNK_OVERLAP) -> str:
    """CTE text (to follow WITH RECURSIVE) defining ``chunks(key, chunk_index, chunk_start,
    chunk_text)`` over ``source``: the chunk rule as a recursive query."""
    w = f"substr(d.{text}, s.start + 1, {size})"
    dot, sp = _last_sql(w, "."), _last_sql(w, " ")
    inner_b = f"(CASE WHEN {dot} > 0 THEN s.start + {dot} WHEN {sp} > 0 THEN s.start + {sp} ELSE s.start + {size} END)"
    b = f"(CASE WHEN s.start + {size} >= d.n THEN s.pb ELSE {inner_b} END)"
    end = f"(CASE WHEN s.start + {size} >= d.n THEN d.n ELSE {inner_b} + 1 END)"
    return f"""
_cdocs AS (SELECT {key} AS k, {text}, length({text}) AS n FROM {source} WHERE {text} IS NOT NULL),
_steps(k, idx, start, pb) AS (
  SELECT k, 0, 0, -1 FROM _cdocs WHERE n > {size}
  UNION ALL
  SELECT s.k, s.idx + 1, greatest(s.start + {size - overlap}, {b} + 1), {b}
  FROM _steps s JOIN _cdocs d ON s.k = d.k WHERE s.start < d.n
),
chunks AS (
  SELECT s.k AS {key}, CAST(s.idx AS INTEGER) AS chunk_index, CAST(s.start AS INTEGER) AS chunk_start,
         {sql_strip(f"substr(d.{text}, s.start + 1, {end} - s.start)")} AS chunk_text
  FROM _steps s JOIN _cdocs d ON s.k = d.k WHERE s.start < d.n
  UNION ALL
  SELECT k AS {key}, 0, 0, {text} FROM _cdocs WHERE n <= {size}
)"""


_CHUNK_DOCS_SQL = "WITH RECURSIVE " + chunk_sql("documents", "doc_id", "text").lstrip() + "\nSELECT * FROM chunks"


@register("chunk_text", _CHUNK_DOCS_SQL)
def q_chunk_text(spark, sf_dir):
    return CH.chunk_text(FX.load(spark, sf_dir, "documents"), "text", ["doc_id"], method="arrow")


@register("chunk_text_native", _CHUNK_DOCS_SQL)
def q_chunk_text_native(spark, sf_dir):
    return CH.chunk_text(FX.load(spark, sf_dir, "documents"), "text", ["doc_id"], method="native")


@register(
    "chunk_payload",
    FX.sql_with("txt_documents", recursive=True, extra=chunk_sql("txt_documents", "file_id", "content").strip())
    + """
SELECT c.file_id, c.chunk_index, c.chunk_text AS text,
       strftime(t.upload_datetime + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS upload_timestamp,
       CAST(length(c.chunk_text) AS INTEGER) AS text_length, 'staging/txts/' || t.source_file AS source
FROM chunks c JOIN txt_documents t USING (file_id)""",
)
def q_chunk_payload(spark, sf_dir):
    t = FX.txt_documents(spark, sf_dir).select(
        "file_id", "content", "upload_datetime", F.concat(F.lit("staging/txts/"), F.col("source_file")).alias("source")
    )
    # keys carried through the flat-map, so no join back to the table is needed
    ch = CH.chunk_text(t, "content", ["file_id", "upload_datetime", "source"])
    return CH.chunk_payload(ch, F.col("upload_datetime")).drop("upload_datetime")


_WORDS_SQL = f"""
_tok AS (
  SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+') AS toks FROM documents)
),
_wf AS (
  SELECT doc_id, word, count(*) AS freq, min(pos) - 1 AS first_pos FROM _tok
  WHERE regexp_full_match(word, '[a-z]{{3,}}') AND word NOT IN ({", ".join(f"'{w}'" for w in S.STOP_WORDS)})
  GROUP BY doc_id, word
),
_rk AS (
  SELECT doc_id, word, freq, row_number() OVER (PARTITION BY doc_id ORDER BY freq DESC, first_pos) AS rank FROM _wf
)"""


@register("word_frequency", "WITH " + _WORDS_SQL.strip() + "\nSELECT doc_id, word, freq, first_pos FROM _wf")
def q_word_frequency(spark, sf_dir):
    return KW.word_frequency(FX.load(spark, sf_dir, "documents"), "text", ["doc_id"])


@register(
    "keyword_ranks", "WITH " + _WORDS_SQL.strip() + "\nSELECT doc_id, word, freq, CAST(rank AS INTEGER) AS rank FROM _rk WHERE rank <= 10"
)
def q_keyword_ranks(spark, sf_dir):
    return KW.keyword_ranks(FX.load(spark, sf_dir, "documents"), "text", ["doc_id"], 10)


@register(
    "extract_keywords",
    "WITH "
    + _WORDS_SQL.strip()
    + """
SELECT d.doc_id, coalesce(k.keywords, []::VARCHAR[]) AS keywords
FROM documents d LEFT JOIN (
  SELECT doc_id, list(word ORDER BY rank) AS keywords FROM _rk WHERE rank <= 10 GROUP BY doc_id
) k USING (doc_id)""",
)
def q_extract_keywords(spark, sf_dir):
    return KW.extract_keywords(FX.load(spark, sf_dir, "documents"), "text", ["doc_id"], 10)


# ---------------------------------------------------------------------------------------------
# S1-S6, S12 listings; P1-P9 validation and gates
# ---------------------------------------------------------------------------------------------

from ..operators import validate as VD  # noqa: E402
from ..sources import listing as LS  # noqa: E402

SIZE_LIMIT_MB = 0.01  # 10,485.76 bytes: small enough that the size rule fires on the fixtures
_LIMIT_BYTES = SIZE_LIMIT_MB * 1024 * 1024

_LISTING_SQL = "SELECT object_name AS name, file_size AS size, upload_datetime AS last_modified, md5(content) AS etag, false AS is_dir FROM staged_files"


def _listing(spark, sf_dir):
    return LS.listing_from_staged(FX.staged_files(spark, sf_dir))


@register("file_listing", FX.sql_with("staged_files") + _LISTING_SQL)
def q_file_listing(spark, sf_dir):
    return _listing(spark, sf_dir)


@register(
    "file_listing_typed",
    FX.sql_with("staged_files", extra=f"listing AS ({_LISTING_SQL})") + "SELECT * FROM listing WHERE starts_with(name, 'pdfs/')",
)
def q_file_listing_typed(spark, sf_dir):
    return LS.typed_listing(_listing(spark, sf_dir), "pdf")


@register(
    "file_listing_counts",
    FX.sql_with("staged_files", extra=f"listing AS ({_LISTING_SQL})")
    + "SELECT regexp_extract(name, '^(pdf|txt)s/', 1) AS type, count(*) AS total_count FROM listing "
    "WHERE regexp_extract(name, '^(pdf|txt)s/', 1) <> '' GROUP BY 1",
)
def q_file_listing_counts(spark, sf_dir):
    return LS.listing_counts(_listing(spark, sf_dir))


_CATALOG_SQL = (
    "SELECT *, 'pdf' AS type FROM listing WHERE starts_with(name, 'pdfs/') "
    "UNION ALL SELECT *, 'txt' AS type FROM listing WHERE starts_with(name, 'txts/')"
)


@register("file_catalog_all", FX.sql_with("staged_files", extra=f"listing AS ({_LISTING_SQL})") + _CATALOG_SQL)
def q_file_catalog_all(spark, sf_dir):
    return LS.catalog_all(_listing(spark, sf_dir)).drop("_type_ord")


@register(
    "file_catalog_filtered",
    FX.sql_with("staged_files", extra=f"listing AS ({_LISTING_SQL})") + f"SELECT * FROM ({_CATALOG_SQL}) WHERE type = 'txt'",
)
def q_file_catalog_filtered(spark, sf_dir):
    return LS.catalog_all(_listing(spark, sf_dir), "TXT").drop("_type_ord")


@register(
    "file_info",
    FX.sql_with("staged_files", extra=f"listing AS ({_LISTING_SQL})") + "SELECT * FROM listing WHERE name = 'pdfs/doc_3-src3.v1.pdf'",
)
def q_file_info(spark, sf_dir):
    return LS.file_info(_listing(spark, sf_dir), "pdf", "doc_3-src3.v1.pdf")


def _size_rule_sql(size: str, filename: str) -> str:
    return (
        f"CASE WHEN {size} > {_LIMIT_BYTES} THEN 413 WHEN {size} = 0 THEN 400 END",
        f"CASE WHEN {size} > {_LIMIT_BYTES} THEN 'File ' || {filename} || ' has size exceeds {SIZE_LIMIT_MB}MB limit' "
        f"WHEN {size} = 0 THEN 'File is empty' END",
    )


_SC, _DT = _size_rule_sql("octet_length(content)", "filename")


@register(
    "validate_file_size",
    FX.sql_with("upload_candidates") + f"SELECT doc_id, {_SC} AS status_code, {_DT} AS detail FROM upload_candidates",
)
def q_validate_file_size(spark, sf_dir):
    c = FX.upload_candidates(spark, sf_dir)
    r = VD.file_size_rule(F.octet_length("content"), F.col("filename"), SIZE_LIMIT_MB)
    return c.select("doc_id", r["status_code"].alias("status_code"), r["detail"].alias("detail"))


@register(
    "validate_filename",
    FX.sql_with("upload_candidates")
    + r"""
SELECT doc_id, filename,
  CASE WHEN filename = '' THEN 'Filename cannot be empty'
       WHEN regexp_matches(filename, '[<>:"|?*\\/]')
         THEN 'Filename contains invalid characters: [''<'', ''>'', '':'', ''"'', ''|'', ''?'', ''*'', ''\\'', ''/'']'
       WHEN length(filename) > 255 THEN 'Filename too long (maximum 255 characters)'
       WHEN NOT ends_with(lower(filename), '.' || lower(file_type)) THEN 'Filename must end with .' || lower(file_type)
  END AS detail
FROM (SELECT doc_id, file_type,
        CASE doc_id % 10 WHEN 3 THEN '' WHEN 4 THEN 'a?' || filename WHEN 5 THEN 'b\' || filename
          WHEN 6 THEN repeat('n', 250) || filename ELSE filename END AS filename FROM upload_candidates)""",
)
def q_validate_filename(spark, sf_dir):
    c = FX.upload_candidates(spark, sf_dir)
    k, name = F.col("doc_id") % 10, F.col("filename")
    odd = F.when(k == 3, "").when(k == 4, F.concat(F.lit("a?"), name)).when(k == 5, F.concat(F.lit("b\\"), name))
    c = c.withColumn("filename", odd.when(k == 6, F.concat(F.repeat(F.lit("n"), F.lit(250)), name)).otherwise(name))
    return c.select("doc_id", "filename", VD.filename_rule(F.col("filename"), F.col("file_type"))["detail"].alias("detail"))


@register(
    "validate_txt_content",
    FX.sql_with("upload_candidates")
    + f"""
SELECT doc_id, CASE WHEN length({sql_strip('decode(content)')}) = 0 THEN 'Text file is empty or contains only whitespace' END AS detail
FROM upload_candidates WHERE file_type = 'txt'""",
)
def q_validate_txt_content(spark, sf_dir):
    c = FX.upload_candidates(spark, sf_dir).where(F.col("file_type") == "txt")
    return c.select("doc_id", VD.txt_content_rule(F.col("content"))["detail"].alias("detail"))


@register(
    "upload_gate",
    FX.sql_with("upload_candidates", extra=f"listing AS ({_LISTING_SQL})")
    + f"""
SELECT filename, file_type, status_code, detail, file_size,
       CASE WHEN status_code = 201 THEN upload_path END AS upload_path,
       CASE WHEN status_code = 201 THEN (CASE WHEN file_type = 'pdf' THEN 'application/pdf' ELSE 'text/plain' END) END AS content_type
FROM (
  SELECT c.filename, c.file_type, c.upload_path, c.file_size,
    CASE WHEN NOT ends_with(lower(c.filename), '.' || c.file_type) THEN 400
         WHEN c.file_size > {_LIMIT_BYTES} THEN 413 WHEN c.file_size = 0 THEN 400
         WHEN c.file_type = 'txt' AND length({sql_strip('decode(c.content)')}) = 0 THEN 400
         WHEN l.name IS NOT NULL THEN 409 ELSE 201 END AS status_code,
    CASE WHEN NOT ends_with(lower(c.filename), '.' || c.file_type) THEN 'Only ' || upper(c.file_type) || ' files are allowed'
         WHEN c.file_size > {_LIMIT_BYTES} THEN 'File ' || c.filename || ' has size exceeds {SIZE_LIMIT_MB}MB limit'
         WHEN c.file_size = 0 THEN 'File is empty'
         WHEN c.file_type = 'txt' AND length({sql_strip('decode(c.content)')}) = 0 THEN 'Text file is empty or contains only whitespace'
         WHEN l.name IS NOT NULL THEN 'File ''' || c.filename || ''' already exists'
         ELSE upper(c.file_type) || ' file uploaded successfully' END AS detail
  FROM (SELECT *, file_type || 's/' || filename AS upload_path, CAST(octet_length(content) AS BIGINT) AS file_size FROM upload_candidates) c
  LEFT JOIN (SELECT DISTINCT name FROM listing) l ON l.name = c.upload_path
)""",
)
def q_upload_gate(spark, sf_dir):
    return VD.upload_gate(FX.upload_candidates(spark, sf_dir), _listing(spark, sf_dir), SIZE_LIMIT_MB)


@register(
    "upload_gate_conflict",
    FX.sql_with("upload_candidates", "txt_documents")
    + """
SELECT c.filename, CASE WHEN t.source_file IS NULL THEN 201 ELSE 409 END AS status_code,
  CASE WHEN t.source_file IS NULL THEN 'TXT file uploaded successfully'
       ELSE 'Content of ''' || c.filename || ''' is already stored as ''' || t.source_file || '''' END AS detail
FROM (SELECT *, doc_id % 10 AS k FROM upload_candidates WHERE file_type = 'txt') c
LEFT JOIN (SELECT content_hash, arg_min(source_file, (upload_datetime, file_id, source_file)) AS source_file
  FROM txt_documents WHERE file_size % 2 = 0 GROUP BY content_hash) t ON t.content_hash = md5(c.content)
WHERE c.k > 2""",
)
def q_upload_gate_conflict(spark, sf_dir):
    # The stored table holds about half of the contents that are uploaded under new names.
    root = _stored(spark, FX.txt_documents(spark, sf_dir).where("file_size % 2 = 0"), S.TXT_TABLE)
    c = FX.upload_candidates(spark, sf_dir).where("file_type = 'txt' AND doc_id % 10 > 2")
    held = TB.content_conflicts(spark, root, S.TXT_TABLE, VD.content_hashes(c))
    gate = VD.upload_gate(c, _listing(spark, sf_dir), stored=held)
    return gate.select("filename", "status_code", "detail")


@register(
    "delete_plan",
    FX.sql_with("staged_files", extra=f"listing AS ({_LISTING_SQL})")
    + """
SELECT r.file_path, CASE WHEN l.name IS NULL THEN 404 ELSE 200 END AS status_code,
       CASE WHEN l.name IS NULL THEN 'File ''' || r.file_path || ''' not found' ELSE 'File deleted successfully' END AS detail,
       CASE WHEN l.name IS NOT NULL THEN regexp_extract(r.file_path, '[^/]*$', 0) END AS filename,
       CASE WHEN l.name IS NOT NULL THEN r.file_path END AS deleted_path
FROM (SELECT object_name AS file_path FROM staged_files UNION ALL SELECT 'gone/' || object_name FROM staged_files) r
LEFT JOIN (SELECT DISTINCT name FROM listing) l ON l.name = r.file_path""",
)
def q_delete_plan(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir)
    req = s.select(F.col("object_name").alias("file_path")).unionByName(
        s.select(F.concat(F.lit("gone/"), F.col("object_name")).alias("file_path"))
    )
    return VD.delete_plan(req, _listing(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# T7-T10 records, W4 silver path, S6 silver read
# ---------------------------------------------------------------------------------------------

from ..operators import records as RC  # noqa: E402


@register(
    "silver_path",
    FX.sql_with("staged_files")
    + "SELECT doc_id, 'silver/pdfs/' || regexp_replace(filename, '\\.[^.]*$', '') || '.md' AS path FROM staged_files WHERE file_type = 'pdf'",
)
def q_silver_path(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    return s.select("doc_id", RC.silver_path(F.col("filename")).alias("path"))


@register("silver_read", FX.sql_with("silver_documents") + "SELECT path, text FROM silver_documents WHERE text IS NOT NULL AND text <> ''")
def q_silver_read(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    silver = s.select(RC.silver_path(F.col("filename")).alias("path"), F.col("content").alias("raw"))
    return LS.silver_read(silver, "path", bytes_col="raw")


@register("txt_records", FX.sql_with("txt_documents") + "SELECT * FROM txt_documents")
def q_txt_records(spark, sf_dir):
    files = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "txt")
    return RC.txt_records(files, run_epoch=F.col("upload_epoch"))


@register("pdf_records", FX.sql_with("pdf_documents") + "SELECT * FROM pdf_documents")
def q_pdf_records(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    extracted = s.select(
        "filename",
        "text",
        "file_size",
        "upload_datetime",
        "upload_epoch",
        F.ceil(F.col("n_chars") / F.lit(3000.0)).cast("int").alias("page_count"),
        FX.summary_of("text", "lang").alias("summarize_details"),
    )
    return RC.pdf_records(extracted, run_epoch=F.col("upload_epoch"))


@register("decode_cascade", FX.sql_with("staged_files") + "SELECT doc_id, text, 'utf-8' AS encoding FROM staged_files")
def q_decode_cascade(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir)
    d = RC.DC.decode_bytes("content")
    return s.select("doc_id", d["text"].alias("text"), d["encoding"].alias("encoding"))


@register(
    "decode_cascade_latin1",
    FX.sql_with("staged_files")
    + r"""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text WHEN length(t) % 2 = 1 THEN t ELSE t || 'é' END AS text,
       CASE WHEN doc_id % 2 = 0 THEN 'utf-16' ELSE 'latin-1' END AS encoding
FROM (SELECT *, regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') || 'é' AS t FROM staged_files)""",
)
def q_decode_cascade_latin1(spark, sf_dir):
    # Bytes that are not UTF-8, with known answers: UTF-16 with a byte order mark, and ISO-8859-1 of odd length
    # that ends in a lone lead byte.
    s = FX.staged_files(spark, sf_dir)
    wide = F.concat(F.lit(b"\xff\xfe"), F.encode("text", "UTF-16LE"))
    t = F.concat(F.regexp_replace("text", r"[^\x00-\xFF]", "?"), F.lit("é"))
    narrow = F.encode(F.when(F.length(t) % 2 == 1, t).otherwise(F.concat(t, F.lit("é"))), "ISO-8859-1")
    d = RC.DC.decode_bytes(F.when(F.col("doc_id") % 2 == 0, wide).otherwise(narrow))
    return s.select("doc_id", d["text"].alias("text"), d["encoding"].alias("encoding"))


@register(
    "decode_and_clean", FX.sql_with("staged_files") + f"SELECT doc_id, 'utf-8' AS encoding, {sql_clean('text')} AS content FROM staged_files"
)
def q_decode_and_clean(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir).select("doc_id", "content")
    return RC.decode_and_clean(s)


@register(
    "extract_fallback",
    FX.sql_with("staged_files")
    + f"""
SELECT doc_id, CASE WHEN doc_id % 15 = 6 THEN '[Error extracting content]' ELSE
  coalesce(regexp_replace(trim(regexp_replace(
    CASE WHEN lang = 'es' THEN 'OCR: ' || text WHEN lang = 'fr' THEN 'OCR: ' || text WHEN lang = 'de' THEN '[No text content found]' ELSE text END,
    '{SQL_WS}+', ' ', 'g')), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g'), '') END AS text
FROM staged_files WHERE file_type = 'pdf'""",
)
def q_extract_fallback(spark, sf_dir):
    # By language: no primary text, a blank one, neither, or a whole one; some files fail in extraction.
    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    lang, text = F.col("lang"), F.col("text")
    primary = F.when(lang == "fr", F.lit(" \n ")).when(~lang.isin("es", "de"), text)
    secondary = F.when(lang != "de", F.concat(F.lit("OCR: "), text))
    return s.select("doc_id", RC.extraction_fallback(primary, secondary, F.col("doc_id") % 15 == 6).alias("text"))


@register(
    "extract_pages",
    FX.sql_with("staged_files")
    + """
SELECT object_name, coalesce(string_agg(p, chr(10) || chr(10) ORDER BY n) FILTER (WHERE length(p) % 7 <> 3 AND p <> ''), '') AS text,
  CAST(count(*) AS INTEGER) AS page_count, CAST(count(*) FILTER (WHERE length(p) % 7 = 3) AS INTEGER) AS failed_pages,
  CASE WHEN count(*) = count(*) FILTER (WHERE length(p) % 7 = 3) THEN 'ValueError: page of ' || arg_min(length(p), n) END AS error
FROM (SELECT object_name, unnest(pages) AS p, unnest(range(len(pages))) AS n
  FROM (SELECT object_name, string_split(text, '. ') AS pages FROM staged_files WHERE file_type = 'pdf')) GROUP BY object_name""",
)
def q_extract_pages(spark, sf_dir):
    # A sentence is a page here; pages of some lengths cannot be read and cost only themselves.
    def read_page(page):
        if len(page) % 7 == 3:
            raise ValueError(f"page of {len(page)}")
        return page

    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "pdf").select("object_name", "content")
    return RC.join_pages(RC.extract_pages(s, lambda data: data.decode().split(". "), read_page), "object_name")


@register(
    "pdf_records_legacy",
    FX.sql_with("staged_files", extra=f"""_legacy AS (
  SELECT filename, upload_datetime, upload_epoch, sha256(content) AS sha, CAST(octet_length(content) AS BIGINT) AS file_size, n_chars,
         coalesce(regexp_replace(trim(regexp_replace(text, '{SQL_WS}+', ' ', 'g')), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g'), '') AS cleaned
  FROM staged_files WHERE file_type = 'pdf'),
_legacy2 AS (SELECT *, left({sql_lstrip('cleaned')}, 100) AS h FROM _legacy)""")
    + f"""
SELECT 'pdf_' || substr(sha, 1, 16) || '_' || upload_epoch AS file_id, upload_datetime,
       coalesce({sql_title_from_content('cleaned', 'h')}, replace(filename, '.pdf', '')) AS title,
       cleaned AS content, filename AS source_file, file_size, sha AS content_hash,
       CASE WHEN n_chars > 3000 THEN CAST(ceil(n_chars / 3000.0) AS INTEGER) ELSE 0 END AS page_count, 1 AS version
FROM _legacy2""",
)
def q_pdf_records_legacy(spark, sf_dir):
    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "pdf")
    pages = F.when(F.col("n_chars") > 3000, F.ceil(F.col("n_chars") / F.lit(3000.0)).cast("int"))
    return RC.pdf_records_legacy(s.withColumn("page_count", pages), F.col("upload_epoch"))


# ---------------------------------------------------------------------------------------------
# S7-S11 table reads, A1 statistics, Q2 lookup
# ---------------------------------------------------------------------------------------------

from ..sources import statistics as ST  # noqa: E402
from ..sources import tables as TB  # noqa: E402


def _stored(spark, records, name):
    """A document table, written by the library's append into a warehouse in the shared folder."""
    root = f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}"
    TB.ensure_tables(spark, root, {name: S.TABLE_SCHEMAS[name]})
    TB.append_documents(records, root, name)
    return root


@register("table_read", FX.sql_with("pdf_documents") + "SELECT *, strftime(upload_datetime, '%Y-%m') AS upload_month FROM pdf_documents")
def q_table_read(spark, sf_dir):
    root = _stored(spark, FX.pdf_documents(spark, sf_dir), S.PDF_TABLE)
    return TB.read_table(spark, root, S.PDF_TABLE)


@register(
    "table_page",
    FX.sql_with("txt_documents") + "SELECT * FROM txt_documents ORDER BY upload_datetime, file_id, source_file LIMIT 50 OFFSET 100",
)
def q_table_page(spark, sf_dir):
    return TB.table_page(FX.txt_documents(spark, sf_dir), limit=50, offset=100)


@register(
    "table_page_counts",
    FX.sql_with("txt_documents")
    + "SELECT count(*) AS total_rows, CAST(least(greatest(count(*) - 100, 0), 50) AS BIGINT) AS returned_rows, "
    "100 AS \"offset\", 50 AS \"limit\" FROM txt_documents",
)
def q_table_page_counts(spark, sf_dir):
    return TB.page_counts(FX.txt_documents(spark, sf_dir), limit=50, offset=100)


_TWINS = (
    "SELECT * EXCLUDE (upload_epoch) REPLACE (TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (upload_epoch // 86400 % 5) AS upload_datetime, "
    "substr(file_id, 1, 5) AS file_id) "
    "FROM (SELECT t.*, s.upload_epoch FROM txt_documents t JOIN staged_files s ON s.filename = t.source_file)"
)


@register(
    "table_page_after",
    FX.sql_with("txt_documents", "staged_files")
    + f"""
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY upload_datetime, file_id, source_file) AS n FROM ({_TWINS}))
WHERE n > 10 AND n <= 40""".replace("SELECT * FROM (SELECT *, row", "SELECT * EXCLUDE (n) FROM (SELECT *, row"),
)
def q_table_page_after(spark, sf_dir):
    # Many rows share upload time and id here; the second page starts after the last row of the first.
    t = FX.txt_documents(spark, sf_dir).withColumn("upload_epoch", TX.epoch_seconds("upload_datetime"))
    day = F.make_dt_interval((F.floor(F.col("upload_epoch") / 86400) % 5).cast("int"))
    t = t.withColumn("upload_datetime", F.lit("2024-01-01").cast("timestamp_ntz") + day).drop("upload_epoch")
    t = t.withColumn("file_id", F.substring("file_id", 1, 5))
    key = TB.total_order(t)
    last = TB.page_after(t, None, 10).select(*key).tail(1)  # one key
    return TB.page_after(t, tuple(last[0]), 30)


@register(
    "append_dedupe",
    FX.sql_with("staged_files").rstrip()
    + """,
f AS (SELECT source || '.txt' AS source_file, md5(text) AS content_hash, min(upload_datetime) AS upload_datetime FROM staged_files GROUP BY ALL),
held AS (SELECT DISTINCT source || '.txt' AS source_file, md5(text) AS content_hash FROM staged_files WHERE lang = 'en'),
n AS (SELECT source_file, count(*) AS n FROM held GROUP BY source_file)
SELECT source_file, content_hash, upload_datetime,
       CAST(coalesce(n, 0) + row_number() OVER (PARTITION BY source_file ORDER BY upload_datetime, content_hash) AS INTEGER) AS version
FROM f ANTI JOIN held USING (source_file, content_hash) LEFT JOIN n USING (source_file)""",
)
def q_append_dedupe(spark, sf_dir):
    # The table holds one language's files; all files arrive in a later run under 20 names.
    s = FX.staged_files(spark, sf_dir)
    batch = s.select(
        F.concat("source", F.lit(".txt")).alias("source_file"),
        F.md5("text").alias("content_hash"),
        "upload_datetime",
        F.col("doc_id").cast("string").alias("file_id"),
        F.lit(1).alias("version"),
        "lang",
    )
    none = batch.limit(0)
    held = TB.plan_append(batch.where("lang = 'en'").drop("lang"), none)
    return TB.plan_append(batch.drop("lang"), held).drop("file_id")


@register(
    "append_pruned",
    FX.sql_with("txt_documents")
    + """
SELECT * REPLACE (md5(content || 'again') AS content_hash, content || 'again' AS content, 2 AS version)
FROM txt_documents WHERE strftime(upload_datetime, '%Y-%m-%d') <= '2024-01-04'
UNION ALL
SELECT * REPLACE ('new_' || source_file AS source_file) FROM txt_documents WHERE strftime(upload_datetime, '%Y-%m-%d') <= '2024-01-02'""",
)
def q_append_pruned(spark, sf_dir):
    # Into a stored table: its own rows again, some of its names with new bytes, and some new names.
    t = FX.txt_documents(spark, sf_dir)
    root = _stored(spark, t, S.TXT_TABLE)
    day = F.date_format("upload_datetime", "yyyy-MM-dd")
    changed = F.concat("content", F.lit("again"))
    again = t.where(day <= "2024-01-04").withColumns({"content": changed, "content_hash": F.md5(changed)})
    new = t.where(day <= "2024-01-02").withColumn("source_file", F.concat(F.lit("new_"), "source_file"))
    return TB.append_documents(t.unionByName(again).unionByName(new), root, S.TXT_TABLE)


@register(
    "table_page_deep",
    FX.sql_with("txt_documents", "staged_files")
    + f"SELECT * FROM ({_TWINS}) ORDER BY upload_datetime, file_id, source_file LIMIT 40 OFFSET 120",
)
def q_table_page_deep(spark, sf_dir):
    # Many rows share upload time and id here; the offset is found by counts of key ranges of at most 20 rows.
    t = FX.txt_documents(spark, sf_dir).withColumn("upload_epoch", TX.epoch_seconds("upload_datetime"))
    day = F.make_dt_interval((F.floor(F.col("upload_epoch") / 86400) % 5).cast("int"))
    t = t.withColumn("upload_datetime", F.lit("2024-01-01").cast("timestamp_ntz") + day).drop("upload_epoch")
    return TB.table_page(t.withColumn("file_id", F.substring("file_id", 1, 5)), limit=40, offset=120, deep=20)


@register(
    "table_schema",
    """
SELECT * FROM (VALUES (1, 'file_id', 'string', true), (3, 'upload_datetime', 'timestamp_ntz', true), (4, 'title', 'string', true),
  (5, 'summarize_details', 'string', false), (6, 'content', 'string', true), (7, 'source_file', 'string', true),
  (8, 'file_size', 'bigint', true), (9, 'page_count', 'int', false), (10, 'version', 'int', true),
  (11, 'content_hash', 'string', true)) AS t(id, name, type, required)""",
)
def q_table_schema(spark, sf_dir):
    # The schema that the stored table's files carry.
    root = _stored(spark, FX.pdf_documents(spark, sf_dir), S.PDF_TABLE)
    return TB.table_schema(spark.read.parquet(f"{root}/{S.PDF_TABLE}"))


def _stats_sql(view: str, name: str) -> str:
    schema = S.TABLE_SCHEMAS[name]
    parts = []
    for i, f in enumerate(schema.fields):
        w = TB._fixed_width(f.dataType)
        if f.dataType.simpleString() == "string":
            b = f"CAST(coalesce(sum(strlen({f.name})), 0) AS BIGINT)"
        elif w is not None:
            b = f"CAST(count({f.name}) * {w} AS BIGINT)"
        else:
            b = "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{name}' AS table_name, {i + 1} AS position, '{f.name}' AS column_name, count(*) AS row_count, "
            f"{len(schema.fields)} AS column_count, CAST(count(*) - count({f.name}) AS BIGINT) AS null_count, {b} AS data_bytes FROM {view}"
        )
    return "\nUNION ALL\n".join(parts)


@register(
    "table_statistics",
    FX.sql_with("pdf_documents", "txt_documents") + _stats_sql("pdf_documents", S.PDF_TABLE) + "\nUNION ALL\n" + _stats_sql("txt_documents", S.TXT_TABLE),
)
def q_table_statistics(spark, sf_dir):
    p = TB.table_statistics(FX.pdf_documents(spark, sf_dir), S.PDF_TABLE)
    t = TB.table_statistics(FX.txt_documents(spark, sf_dir), S.TXT_TABLE)
    return p.unionByName(t)


@register(
    "table_statistics_stored",
    FX.sql_with("txt_documents") + _stats_sql("txt_documents", S.TXT_TABLE),
)
def q_table_statistics_stored(spark, sf_dir):
    # Kept by month: a first part of the table is counted, then only the months that the rest was added to.
    t = FX.txt_documents(spark, sf_dir)
    root = _stored(spark, t.where("file_size % 3 > 0"), S.TXT_TABLE)
    ST.refresh_statistics(spark, root, S.TXT_TABLE)
    TB.append_documents(t.where("file_size % 3 = 0"), root, S.TXT_TABLE)
    return ST.stored_statistics(spark, root, S.TXT_TABLE).drop("distinct_estimate")


_LOOKUP_NAME = "doc_1-src1.v1.txt"


@register(
    "document_by_id",
    FX.sql_with("pdf_documents", "txt_documents")
    + f"""
SELECT * EXCLUDE (_ord) FROM (
  SELECT *, 'pdf_documents' AS source_table, 0 AS _ord FROM pdf_documents
  UNION ALL BY NAME
  SELECT *, 'txt_documents' AS source_table, 1 AS _ord FROM txt_documents
) WHERE file_id = (SELECT file_id FROM txt_documents WHERE source_file = '{_LOOKUP_NAME}')
ORDER BY _ord, upload_datetime, file_id, source_file LIMIT 1""",
)
def q_document_by_id(spark, sf_dir):
    tables = _doc_tables(spark, sf_dir)
    # The id is looked up as a scalar subquery, so the query needs no hash literal.
    wanted = tables[S.TXT_TABLE].where(F.col("source_file") == _LOOKUP_NAME).select("file_id").scalar()
    return SR.document_by_id(tables, wanted)


@register(
    "documents_by_ids",
    FX.sql_with("pdf_documents", "txt_documents")
    + """
SELECT * EXCLUDE (_ord, _rn, file_id) RENAME (requested_id AS file_id) FROM (
  SELECT r.requested_id, u.*, row_number() OVER (PARTITION BY r.requested_id ORDER BY u._ord NULLS LAST, u.upload_datetime, u.source_file) AS _rn
  FROM (SELECT DISTINCT requested_id FROM (
          SELECT file_id AS requested_id FROM pdf_documents UNION ALL SELECT file_id FROM txt_documents
          UNION ALL SELECT 'missing_' || file_id FROM txt_documents)) r
  LEFT JOIN (
    SELECT *, 'pdf_documents' AS source_table, 0 AS _ord FROM pdf_documents
    UNION ALL BY NAME
    SELECT *, 'txt_documents' AS source_table, 1 AS _ord FROM txt_documents
  ) u ON u.file_id = r.requested_id
) WHERE _rn = 1""",
)
def q_documents_by_ids(spark, sf_dir):
    tables = _doc_tables(spark, sf_dir)
    ids = tables[S.PDF_TABLE].select("file_id").unionByName(tables[S.TXT_TABLE].select("file_id"))
    ids = ids.unionByName(tables[S.TXT_TABLE].select(F.concat(F.lit("missing_"), F.col("file_id")).alias("file_id")))
    return SR.documents_by_ids(tables, ids)


# ---------------------------------------------------------------------------------------------
# Q3 vector search, W6-W7 points, A4 info, T3-T6 embedding
# ---------------------------------------------------------------------------------------------

from ..operators import pivots as PV  # noqa: E402
from ..operators import vectors as VC  # noqa: E402

_PAYLOAD = "point_id, vec_id, source, chunk_index, label"
_QVEC = "(SELECT embedding FROM points WHERE vec_id = 0)::DOUBLE[]"


def _query_vector(pts):
    # The query vector is read from the table as a scalar subquery.
    return pts.where(F.col("vec_id") == 0).select("embedding").scalar()


def _round_score(df):
    return df.withColumn("score", F.round("score", 6))


@register(
    "vector_search",
    FX.sql_with("points")
    + f"""
SELECT {_PAYLOAD}, round(score, 6) AS score FROM (
  SELECT *, list_cosine_similarity(embedding::DOUBLE[], {_QVEC}) AS score FROM points WHERE embedding IS NOT NULL)
WHERE score >= 0.0 ORDER BY score DESC, point_id LIMIT 10""",
)
def q_vector_search(spark, sf_dir):
    pts = FX.points(spark, sf_dir)
    return _round_score(VC.vector_search(pts, _query_vector(pts), limit=10, score_threshold=0.0))


@register(
    "vector_search_filtered",
    FX.sql_with("points")
    + f"""
SELECT {_PAYLOAD}, round(score, 6) AS score FROM (
  SELECT *, list_cosine_similarity(embedding::DOUBLE[], {_QVEC}) AS score FROM points WHERE embedding IS NOT NULL AND label = 3)
WHERE score >= 0.05 ORDER BY score DESC, point_id LIMIT 10""",
)
def q_vector_search_filtered(spark, sf_dir):
    pts = FX.points(spark, sf_dir)
    return _round_score(VC.vector_search(pts, _query_vector(pts), limit=10, score_threshold=0.05, filter_conditions={"label": 3}))


@register(
    "vector_search_batch",
    FX.sql_with("points")
    + """
SELECT query_id, point_id, round(score, 6) AS score FROM (
  SELECT q.vec_id AS query_id, p.point_id, list_cosine_similarity(p.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(p.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, p.point_id) AS rn
  FROM (SELECT vec_id, embedding FROM points WHERE label = 0 AND embedding IS NOT NULL) q, points p
  WHERE p.embedding IS NOT NULL AND list_cosine_similarity(p.embedding::DOUBLE[], q.embedding::DOUBLE[]) >= 0.0)
WHERE rn <= 10""",
)
def q_vector_search_batch(spark, sf_dir):
    pts = FX.points(spark, sf_dir)
    queries = pts.where(F.col("label") == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return _round_score(VC.vector_search_batch(pts, queries, k=10, score_threshold=0.0))


@register(
    "vector_search_pruned",
    FX.sql_with("points")
    + f"""
SELECT {_PAYLOAD}, round(score, 6) AS score FROM (
  SELECT *, list_cosine_similarity(embedding::DOUBLE[], {_QVEC}) AS score FROM points WHERE embedding IS NOT NULL)
WHERE score >= 0.0 ORDER BY score DESC, point_id LIMIT 10""",
)
def q_vector_search_pruned(spark, sf_dir):
    pts = FX.points(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/pivots-{uuid.uuid4().hex}"
    PV.build_index(pts, path)
    query = pts.where("vec_id = 0").select("embedding").first()[0]
    return _round_score(PV.PivotIndex(spark, path).search(query, limit=10, score_threshold=0.0))


@register(
    "collection_info",
    FX.sql_with("points")
    + f"""
SELECT 'agent_documents' AS name, 'green' AS status, count(embedding) AS vectors_count, count(*) AS points_count,
       CAST(max(len(embedding)) AS INTEGER) AS vector_size, 'Cosine' AS distance FROM points""",
)
def q_collection_info(spark, sf_dir):
    return VC.collection_info(FX.points(spark, sf_dir))


_POINTS = "point_id, vec_id, source, chunk_index, label, embedding"


@register(
    "points_upsert",
    FX.sql_with("points")
    + f"""
SELECT {_POINTS} FROM points WHERE coalesce(label, -1) <> 1
UNION ALL SELECT point_id, vec_id, source, chunk_index + 200, label, embedding FROM points WHERE label = 1
UNION ALL SELECT 'new_' || point_id, vec_id, source, chunk_index, label, embedding FROM points WHERE label = 2""",
)
def q_points_upsert(spark, sf_dir):
    # Of the new points one label's ids exist already and come twice (the later one holds), another's are new.
    pts = FX.points(spark, sf_dir).withColumn("upload_timestamp", F.lit("2024-01-01"))
    again = pts.where(F.col("label") == 1)
    once = again.withColumn("chunk_index", F.col("chunk_index") + 100).withColumn("upload_timestamp", F.lit("2024-01-02"))
    twice = again.withColumn("chunk_index", F.col("chunk_index") + 200).withColumn("upload_timestamp", F.lit("2024-01-03"))
    fresh = pts.where(F.col("label") == 2).withColumn("point_id", F.concat(F.lit("new_"), F.col("point_id")))
    return VC.upsert_points(pts, once.unionByName(twice).unionByName(fresh)).drop("upload_timestamp")


@register(
    "points_delete_by_filter",
    FX.sql_with("points") + "SELECT point_id, source, chunk_index, embedding FROM points WHERE chunk_index <> 2",
)
def q_points_delete_by_filter(spark, sf_dir):
    # On a stored collection: save, delete by a payload filter, read.
    path = f"{ensure_checkpoint_dir(spark)}/points-{uuid.uuid4().hex}"
    VC.save_points(FX.points(spark, sf_dir), path)
    VC.delete_points(spark, path, {"chunk_index": 2})
    return VC.read_points(spark, path).select("point_id", "source", "chunk_index", "embedding")


@register(
    "files_uploaded",
    FX.sql_with("points")
    + "SELECT count(*) AS files, count(*) FILTER (WHERE n > 0) AS uploaded, count(*) FILTER (WHERE n > 0) > 0 AS success "
    "FROM (SELECT source, count(embedding) AS n FROM points GROUP BY source)",
)
def q_files_uploaded(spark, sf_dir):
    return VC.files_uploaded(VC.points_success(FX.points(spark, sf_dir)))


@register(
    "points_success",
    FX.sql_with("points")
    + "SELECT source, count(*) AS chunks, count(embedding) AS points_written, count(embedding) > 0 AS success FROM points GROUP BY source",
)
def q_points_success(spark, sf_dir):
    return VC.points_success(FX.points(spark, sf_dir))


_MD5_VECTOR = (
    "list_transform(range(16), lambda i: CAST((strpos('0123456789abcdef', substr(md5(chunk_text), 2 * i + 1, 1)) - 1) * 16 "
    "+ strpos('0123456789abcdef', substr(md5(chunk_text), 2 * i + 2, 1)) - 1 - 128 AS FLOAT))"
)


@register(
    "embed_chunks",
    FX.sql_with("txt_documents", recursive=True, extra=chunk_sql("txt_documents", "file_id", "content").strip())
    + f"SELECT *, {_MD5_VECTOR} AS embedding FROM chunks",
)
def q_embed_chunks(spark, sf_dir):
    t = FX.txt_documents(spark, sf_dir).select("file_id", "content")
    return VC.embed_chunks(CH.chunk_text(t, "content", ["file_id"]), VC.md5_embedder)


@register(
    "embed_reusing",
    FX.sql_with("txt_documents", recursive=True, extra=chunk_sql("txt_documents", "file_id", "content").strip())
    + f"SELECT *, {_MD5_VECTOR} AS embedding FROM chunks",
)
def q_embed_reusing(spark, sf_dir):
    # Half of the chunks first, then all of them: the second call embeds only what the store does not have.
    chunks = CH.chunk_text(FX.txt_documents(spark, sf_dir).select("file_id", "content"), "content", ["file_id"])
    store = f"{ensure_checkpoint_dir(spark)}/vectors-{uuid.uuid4().hex}"
    VC.embed_reusing(chunks.where("chunk_index % 2 = 0"), VC.md5_embedder, store, "md5")
    return VC.embed_reusing(chunks, VC.md5_embedder, store, "md5")


def _points_sql(kind: str, key: str) -> str:
    h = f"md5('{kind}#' || {key} || '#' || chunk_index)"
    parts = [f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return f"""
SELECT {" || '-' || ".join(parts)} AS point_id, {_MD5_VECTOR} AS embedding, chunk_text AS text, chunk_index,
       '2024-06-01T07:00:00+07:00' AS upload_timestamp, CAST(length(chunk_text) AS INTEGER) AS text_length,
       {key} AS source, '{kind}' AS kind
FROM chunks"""


@register(
    "vectorize_files",
    FX.sql_with("silver_documents", recursive=True, extra=chunk_sql("silver_documents", "path", "text").strip()) + _points_sql("file", "path"),
)
def q_vectorize_files(spark, sf_dir):
    # T5: silver paths -> read -> chunk -> embed -> points carrying the source path
    silver = LS.silver_read(FX.silver_documents(spark, sf_dir), "path", text_col="text")
    return _points_of(silver, "text", "path", "file")


@register(
    "vectorize_summaries",
    FX.sql_with("pdf_documents", recursive=True, extra=chunk_sql("pdf_documents", "content", "summarize_details").strip())
    + _points_sql("summary", "content"),
)
def q_vectorize_summaries(spark, sf_dir):
    # Chunk each PDF's summary; points keep the silver path as ``source`` (the full text is
    # joined by key when needed instead of being copied into every point).
    pdf = FX.pdf_documents(spark, sf_dir).where(F.col("summarize_details").isNotNull())
    return _points_of(pdf, "summarize_details", "content", "summary")


def _points_of(df, text, key, kind):
    emb = VC.embed_chunks(CH.chunk_text(df.select(key, text), text, [key]), VC.md5_embedder)
    points = VC.build_points(emb, F.col(key), upload_ts=F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"), kind=kind)
    return points.drop("metadata")


# ---------------------------------------------------------------------------------------------
# T11-T13 ingest status, A2-A3 batch summaries
# ---------------------------------------------------------------------------------------------

from ..plans import ingest as IN  # noqa: E402

RUN_TS = "2024-06-01 00:00:00"
RUN_EPOCH = 1717200000


def _candidates_of(spark, sf_dir, file_type):
    c = FX.upload_candidates(spark, sf_dir).where(F.col("file_type") == file_type)
    return c.select(F.concat(F.lit(f"staging/{file_type}s/"), F.col("filename")).alias("object_name"), "content")


def _txt_status(spark, sf_dir):
    plan = IN.txt_ingest_plan(_candidates_of(spark, sf_dir, "txt"), F.lit(RUN_TS), run_epoch=F.lit(RUN_EPOCH))
    return IN.status_rows(plan, "txt")


def _pdf_plan(spark, sf_dir):
    files = _candidates_of(spark, sf_dir, "pdf")
    # Extraction stand-in expressed natively: UTF-8 text of the bytes; an empty file is an error.
    text = F.col("content").cast("string")
    extracted = files.select(
        "object_name",
        F.octet_length("content").alias("file_size"),
        text.alias("text"),
        F.lit(None).cast("int").alias("page_count"),
        F.when(F.octet_length("content") == 0, F.lit("empty document")).alias("error"),
        F.when(F.octet_length("content") > 2000, text).alias("summarize_details"),
        "content",
    )
    return IN.pdf_ingest_plan(extracted, F.lit(RUN_TS), run_epoch=F.lit(RUN_EPOCH))


def _pdf_status(spark, sf_dir):
    return IN.status_rows(_pdf_plan(spark, sf_dir), "pdf")


@register(
    "ingest_quarantine",
    FX.sql_with("upload_candidates")
    + """
SELECT 'staging/' || file_type || 's/' || filename AS object_name, md5(content) AS content_md5,
       'Processing error: ' || CASE WHEN file_type = 'pdf' THEN 'empty document' ELSE 'File is empty' END AS reason
FROM upload_candidates WHERE octet_length(content) = 0""",
)
def q_ingest_quarantine(spark, sf_dir):
    txt = IN.txt_ingest_plan(_candidates_of(spark, sf_dir, "txt"), F.lit(RUN_TS), run_epoch=F.lit(RUN_EPOCH), reject_empty=True)
    bad = IN.quarantined(_pdf_plan(spark, sf_dir)).unionByName(IN.quarantined(txt))
    return bad.select("object_name", F.md5("content").alias("content_md5"), "reason")


@register(
    "silver_upsert",
    FX.sql_with("staged_files")
    + """
SELECT path, text, upload_datetime, object_name FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY upload_datetime DESC, object_name DESC) AS n FROM (
    SELECT 'silver/pdfs/' || source || '.md' AS path, text, upload_datetime, object_name FROM staged_files
    UNION ALL
    SELECT 'silver/pdfs/' || source || '.md', 'new ' || text, upload_datetime + INTERVAL 60 DAY, object_name
    FROM staged_files WHERE lang = 'fr')) WHERE n = 1""",
)
def q_silver_upsert(spark, sf_dir):
    # Many uploads of 20 names; one language's come again later with new texts.
    s = FX.staged_files(spark, sf_dir)
    path = F.concat(F.lit("silver/pdfs/"), F.col("source"), F.lit(".md")).alias("path")
    old = s.select(path, "text", "upload_datetime", "object_name")
    later = (F.col("upload_datetime") + F.make_dt_interval(F.lit(60))).alias("upload_datetime")
    new = s.where("lang = 'fr'").select(path, F.concat(F.lit("new "), F.col("text")).alias("text"), later, "object_name")
    return IN.newest_silver(old, new)


_TXT_STATUS_SQL = f"""
SELECT 'txt_' || substr(sha256(content), 1, 16) || '_{RUN_EPOCH}' AS file_id, filename, 'completed' AS status,
       'TXT processed successfully' AS message, TIMESTAMP '{RUN_TS}' AS processed_at, 'txt' AS file_type
FROM upload_candidates WHERE file_type = 'txt'"""

_PDF_STATUS_SQL = f"""
SELECT CASE WHEN octet_length(content) = 0 THEN '' ELSE 'pdf_' || substr(sha256(decode(content)), 1, 16) || '_{RUN_EPOCH}' END AS file_id,
       filename,
       CASE WHEN octet_length(content) = 0 THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN octet_length(content) = 0 THEN 'Processing error: empty document' ELSE 'PDF processed successfully' END AS message,
       CASE WHEN octet_length(content) = 0 THEN NULL ELSE TIMESTAMP '{RUN_TS}' END AS processed_at,
       'pdf' AS file_type, octet_length(content) > 2000 AS vectorized
FROM upload_candidates WHERE file_type = 'pdf'"""


@register("ingest_txt_status", FX.sql_with("upload_candidates") + _TXT_STATUS_SQL)
def q_ingest_txt_status(spark, sf_dir):
    return _txt_status(spark, sf_dir)


@register("ingest_pdf_status", FX.sql_with("upload_candidates") + _PDF_STATUS_SQL)
def q_ingest_pdf_status(spark, sf_dir):
    return _pdf_status(spark, sf_dir)


def _batch_status(spark, sf_dir):
    return _pdf_status(spark, sf_dir).drop("vectorized").unionByName(_txt_status(spark, sf_dir))


_BATCH_SQL = FX.sql_with(
    "upload_candidates",
    extra=f"batch AS (SELECT * EXCLUDE (vectorized) FROM ({_PDF_STATUS_SQL}) UNION ALL SELECT * FROM ({_TXT_STATUS_SQL}))",
)


@register("batch_status", _BATCH_SQL + "SELECT * FROM batch")
def q_batch_status(spark, sf_dir):
    return _batch_status(spark, sf_dir)


@register(
    "batch_summary",
    _BATCH_SQL
    + "SELECT count(*) AS total_processed, count(*) FILTER (WHERE status = 'completed') AS success_count, "
    "count(*) FILTER (WHERE status <> 'completed') AS error_count, count(*) FILTER (WHERE file_type = 'pdf') AS pdf_count, "
    "count(*) FILTER (WHERE file_type = 'txt') AS txt_count FROM batch",
)
def q_batch_summary(spark, sf_dir):
    return IN.batch_summary(_batch_status(spark, sf_dir))


@register(
    "batch_summary_by_type",
    _BATCH_SQL
    + "SELECT file_type, count(*) AS total_processed, count(*) FILTER (WHERE status = 'completed') AS success_count, "
    "count(*) FILTER (WHERE status <> 'completed') AS error_count FROM batch GROUP BY file_type",
)
def q_batch_summary_by_type(spark, sf_dir):
    return IN.batch_summary_by_type(_batch_status(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# Older TXT record path (T10 + F1/F3/F6/F8/F9)
# ---------------------------------------------------------------------------------------------


@register(
    "txt_records_legacy",
    FX.sql_with("staged_files", extra=f"""_legacy AS (
  SELECT filename, upload_datetime, upload_epoch, sha256(content) AS sha, CAST(octet_length(content) AS BIGINT) AS file_size,
         {sql_clean('text')} AS cleaned
  FROM staged_files WHERE file_type = 'txt'),
_legacy2 AS (SELECT *, left({sql_lstrip('cleaned')}, 100) AS h FROM _legacy)""")
    + f"""
SELECT 'txt_' || substr(sha, 1, 16) || '_' || upload_epoch AS file_id, upload_datetime,
       coalesce({sql_title_from_content('cleaned', 'h')}, replace(filename, '.txt', '')) AS title,
       cleaned AS content, filename AS source_file, {sql_source_link('cleaned')} AS source_link,
       file_size, sha AS content_hash, 1 AS version
FROM _legacy2""",
)
def q_txt_records_legacy(spark, sf_dir):
    files = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "txt").select("filename", "content", "upload_datetime", "upload_epoch")
    return RC.txt_records_legacy(files, F.col("upload_epoch"))


@register(
    "validate_file_size_legacy",
    FX.sql_with("staged_files")
    + """
SELECT doc_id, file_size <= 2097.152 AS ok, CASE WHEN file_size > 2097.152 THEN 'Text file is too large (max 0.002MB)' END AS reason
FROM staged_files WHERE file_type = 'txt'""",
)
def q_validate_file_size_legacy(spark, sf_dir):
    # P6 with a limit that fires on the staged TXT files
    s = FX.staged_files(spark, sf_dir).where(F.col("file_type") == "txt")
    r = VD.txt_size_rule_legacy(F.col("file_size"), 0.002)
    return s.select("doc_id", r["ok"].alias("ok"), r["reason"].alias("reason"))


@register(
    "search_documents_resolved",
    FX.sql_with("pdf_documents", "txt_documents", "silver_documents")
    + f"""
SELECT * EXCLUDE (_ord) FROM (
  SELECT *, 'pdf_documents' AS source_table, 0 AS _ord FROM pdf_documents
  WHERE content IN (SELECT path FROM silver_documents WHERE regexp_matches(text, '{SEARCH_QUERY}', 'i'))
  UNION ALL BY NAME
  SELECT *, 'txt_documents' AS source_table, 1 AS _ord FROM txt_documents WHERE regexp_matches(content, '{SEARCH_QUERY}', 'i')
) ORDER BY _ord, upload_datetime, file_id, source_file LIMIT 10""",
)
def q_search_documents_resolved(spark, sf_dir):
    # PDF rows matched on their extracted (silver) text instead of the stored path
    return SR.search_documents(_doc_tables(spark, sf_dir), SEARCH_QUERY, limit=S.DEFAULT_LIMIT, silver=FX.silver_documents(spark, sf_dir))


from ..operators import trigrams as TG  # noqa: E402

_INDEXED_QUERY = "licen[cs]e|worth(less|while)"


@register(
    "search_indexed",
    FX.sql_with("pdf_documents", "txt_documents")
    + f"""
SELECT * EXCLUDE (_ord) FROM (
  SELECT *, strftime(upload_datetime, '%Y-%m') AS upload_month, 'pdf_documents' AS source_table, 0 AS _ord FROM pdf_documents
  WHERE regexp_matches(content, '{_INDEXED_QUERY}', 'i')
  UNION ALL BY NAME
  SELECT *, strftime(upload_datetime, '%Y-%m') AS upload_month, 'txt_documents' AS source_table, 1 AS _ord FROM txt_documents
  WHERE regexp_matches(content, '{_INDEXED_QUERY}', 'i')
) ORDER BY _ord, upload_datetime, file_id, source_file LIMIT 100""",
)
def q_search_indexed(spark, sf_dir):
    # Both tables stored; one is indexed whole, the other before half of it was added.
    pdf, txt = FX.pdf_documents(spark, sf_dir), FX.txt_documents(spark, sf_dir)
    root = _stored(spark, txt.where("file_size % 2 = 0"), S.TXT_TABLE)
    TB.append_documents(pdf, root, S.PDF_TABLE)
    for name in S.DOCUMENT_TABLES:
        TG.update_index(spark, root, name)
    TB.append_documents(txt.where("file_size % 2 = 1"), root, S.TXT_TABLE)
    return TG.search_indexed(spark, root, _INDEXED_QUERY, 100)
