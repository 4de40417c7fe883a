"""Validation rules as column expressions, and the upload and delete gates.

A rule yields a ``struct(status_code, detail)`` that is null when the row passes; the first failing
rule wins (``coalesce`` in rule order).  The gates are joins of a request DataFrame against a
listing, so a million requests are one distributed plan rather than a million object lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import decode as DC
from ..functions import text as TX
from ..sources import listing as LS

RULE_T = "struct<status_code:int,detail:string>"


def _fail(code: int, detail: Column | str) -> Column:
    d = F.lit(detail) if isinstance(detail, str) else detail
    return F.struct(F.lit(code).alias("status_code"), d.alias("detail"))


def _none() -> Column:
    return F.lit(None).cast(RULE_T)


def file_size_rule(size: Column, filename: Column, max_mb: float = S.MAX_FILE_SIZE_MB) -> Column:
    """Over ``max_mb * 1024**2`` bytes -> 413; zero bytes -> 400; the limit itself passes."""
    limit = max_mb * 1024 * 1024
    too_large = F.concat(F.lit("File "), filename, F.lit(f" has size exceeds {max_mb}MB limit"))
    return F.when(size > limit, _fail(413, too_large)).when(size == 0, _fail(400, S.MSG_FILE_EMPTY)).otherwise(_none())


def txt_size_rule_legacy(size: Column, max_mb: float = S.MAX_TXT_SIZE_MB_LEGACY) -> Column:
    """P6, the older TXT rule: struct(ok, reason); only a size over ``max_mb * 1024**2`` bytes fails (an empty
    file passes, and any bytes decode)."""
    reason = F.when(size > max_mb * 1024 * 1024, F.lit(S.MSG_TXT_TOO_LARGE_LEGACY.format(limit=max_mb)))
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def txt_content_rule(content: Column, min_length: int | None = None) -> Column:
    """Decode by the F10 cascade; nothing left after a Python-style strip -> 400; with ``min_length``
    fewer stripped characters than that, too."""
    stripped = F.length(TX.py_strip(DC.decode_bytes(content)["text"]))
    rule = F.when(stripped == 0, _fail(400, S.MSG_TXT_EMPTY))
    if min_length is not None:
        rule = rule.when(stripped < min_length, _fail(400, S.MSG_TXT_SHORT.format(minimum=min_length)))
    return rule.otherwise(_none())


def filename_rule(filename: Column, file_type: Column | str) -> Column:
    """Empty; a forbidden character; longer than 255; wrong extension (case-insensitive)."""
    ft = F.lit(file_type) if isinstance(file_type, str) else file_type
    forbidden = "[" + "".join("\\" + c for c in S.FORBIDDEN_FILENAME_CHARS) + "]"
    ext = F.concat(F.lit("."), F.lower(ft))
    return (
        F.when(filename.isNull() | (filename == ""), _fail(400, S.MSG_FILENAME_EMPTY))
        .when(filename.rlike(forbidden), _fail(400, S.MSG_FILENAME_CHARS))
        .when(F.length(filename) > S.MAX_FILENAME_LENGTH, _fail(400, S.MSG_FILENAME_LONG))
        .when(~F.lower(filename).endswith(ext), _fail(400, F.concat(F.lit("Filename must end with "), ext)))
        .otherwise(_none())
    )


def extension_rule(filename: Column, file_type: Column | str) -> Column:
    """Upload extension gate."""
    ft = F.lit(file_type) if isinstance(file_type, str) else file_type
    ok = F.lower(filename).endswith(F.concat(F.lit("."), F.lower(ft)))
    msg = F.concat(F.lit("Only "), F.upper(ft), F.lit(" files are allowed"))
    return F.when(ok, _none()).otherwise(_fail(400, msg))


def content_hashes(candidates: DataFrame) -> DataFrame:
    """The hashes that the TXT table would hold for the candidates' bytes (a PDF's is that of its extracted text,
    which an upload does not know yet)."""
    return candidates.where("file_type = 'txt'").select(F.md5("content").alias("content_hash")).distinct()


def upload_gate(
    candidates: DataFrame, listing: DataFrame, max_mb: float = S.MAX_FILE_SIZE_MB, stored: DataFrame | None = None
) -> DataFrame:
    """Per request (``filename``, ``file_type``, ``content``): extension -> size -> content
    -> already present (409) -> accepted (201).  Returns filename, file_type, status_code, detail,
    file_size, upload_path, content_type.  PDF structure validation needs a PDF parser and is not
    part of this gate.  The rules on a file's own bytes run where it is read; only their verdict, not the
    bytes, goes through the existence test, a left join on the object key.

    With ``stored`` (content_hash, source_file; see ``tables.content_conflicts``) a TXT file whose bytes a table
    already holds, under any name, conflicts too (409)."""
    size = F.octet_length("content").cast("long")
    is_txt = F.col("file_type") == "txt"
    own = F.coalesce(
        extension_rule(F.col("filename"), F.col("file_type")),
        file_size_rule(size, F.col("filename"), max_mb),
        F.when(is_txt, txt_content_rule(F.col("content"))).otherwise(_none()),
    )
    judged = candidates.select(
        "filename",
        "file_type",
        F.concat(F.col("file_type"), F.lit("s/"), F.col("filename")).alias("upload_path"),
        size.alias("file_size"),
        own.alias("_own"),
        *([F.when(is_txt, F.md5("content")).alias("_hash")] if stored is not None else []),
    )
    present = listing.select(F.col("name").alias("upload_path")).distinct().withColumn("_present", F.lit(True))
    j = judged.join(present, on="upload_path", how="left")
    exists = F.concat(F.lit("File '"), F.col("filename"), F.lit("' already exists"))
    held = _none()
    if stored is not None:
        same = stored.groupBy(F.col("content_hash").alias("_hash")).agg(F.min("source_file").alias("_stored_as"))
        j = j.join(same, on="_hash", how="left")
        again = F.concat(F.lit("Content of '"), F.col("filename"), F.lit("' is already stored as '"), F.col("_stored_as"), F.lit("'"))
        held = F.when(F.col("_stored_as").isNotNull(), _fail(409, again)).otherwise(_none())
    verdict = F.coalesce(
        F.col("_own"),
        F.when(F.col("_present"), _fail(409, exists)).otherwise(_none()),
        held,
        _fail(201, F.concat(F.upper(F.col("file_type")), F.lit(" file uploaded successfully"))),
    )
    ctype = F.when(F.col("file_type") == "pdf", F.lit(LS.CONTENT_TYPES["pdf"])).otherwise(F.lit(LS.CONTENT_TYPES["txt"]))
    accepted = verdict["status_code"] == 201
    return j.select(
        "filename",
        "file_type",
        verdict["status_code"].alias("status_code"),
        verdict["detail"].alias("detail"),
        "file_size",
        F.when(accepted, F.col("upload_path")).alias("upload_path"),
        F.when(accepted, ctype).alias("content_type"),
    )


def delete_plan(requests: DataFrame, listing: DataFrame) -> DataFrame:
    """Per requested ``file_path``: 404 when absent, else 200 with the deleted path."""
    present = listing.select(F.col("name").alias("file_path")).distinct().withColumn("_present", F.lit(True))
    j = requests.select("file_path").join(present, on="file_path", how="left")
    found = F.coalesce(F.col("_present"), F.lit(False))
    return j.select(
        "file_path",
        F.when(found, F.lit(200)).otherwise(F.lit(404)).alias("status_code"),
        F.when(found, F.lit("File deleted successfully")).otherwise(
            F.concat(F.lit("File '"), F.col("file_path"), F.lit("' not found"))
        ).alias("detail"),
        F.when(found, TX.basename("file_path")).alias("filename"),
        F.when(found, F.col("file_path")).alias("deleted_path"),
    )
