"""Table contracts and fixed values.

The document tables keep the reference's columns and types, plus a required ``content_hash``
(needed for de-duplication and idempotent re-runs) and a derived ``upload_month`` partition column.
"""

from __future__ import annotations

from pyspark.sql import types as T

PDF_TABLE = "pdf_documents"
TXT_TABLE = "txt_documents"
DOCUMENT_TABLES = (PDF_TABLE, TXT_TABLE)  # search / lookup order: PDF first, then TXT



def _table(*columns: tuple[int, str, T.DataType, bool]) -> T.StructType:
    """A table's columns from (field id, name, type, required); id and requirement are kept as metadata, which
    is stored with the files."""
    return T.StructType([T.StructField(n, t, not r, {"id": i, "required": r}) for i, n, t, r in columns])


# Field ids are declared, not positions; content_hash is this library's own column.
PDF_SCHEMA = _table(
    (1, "file_id", T.StringType(), True),
    (3, "upload_datetime", T.TimestampNTZType(), True),
    (4, "title", T.StringType(), True),
    (5, "summarize_details", T.StringType(), False),
    (6, "content", T.StringType(), True),
    (7, "source_file", T.StringType(), True),
    (8, "file_size", T.LongType(), True),
    (9, "page_count", T.IntegerType(), False),
    (10, "version", T.IntegerType(), True),
    (11, "content_hash", T.StringType(), True),
)

TXT_SCHEMA = _table(
    (1, "file_id", T.StringType(), True),
    (3, "upload_datetime", T.TimestampNTZType(), True),
    (4, "title", T.StringType(), True),
    (5, "content", T.StringType(), True),
    (6, "source_file", T.StringType(), True),
    (7, "source_link", T.StringType(), False),
    (8, "file_size", T.LongType(), True),
    (10, "version", T.IntegerType(), True),
    (11, "content_hash", T.StringType(), True),
)

POINT_SCHEMA = T.StructType(
    [
        T.StructField("point_id", T.StringType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType()), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("chunk_index", T.IntegerType(), True),
        T.StructField("text_length", T.IntegerType(), True),
        T.StructField("upload_timestamp", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("kind", T.StringType(), True),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

TABLE_SCHEMAS = {PDF_TABLE: PDF_SCHEMA, TXT_TABLE: TXT_SCHEMA}

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------------------------

# Keyword stop words (48).
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "as",
    "is", "was", "are", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did", "will",
    "would", "could", "should", "may", "might", "must", "can", "this", "that", "these", "those", "i", "you",
    "he", "she", "it", "we", "they",
]

# Lines whose lower-cased text contains one of these are not used as a title.
TITLE_SKIP_PATTERNS = ("created:", "modified:", "author:", "date:", "source:", "url:")

# Lines (lower-cased) with one of these prefixes may carry a source link.
SOURCE_LINK_PREFIXES = ("source:", "url:", "link:", "from:")

# Characters not allowed in an uploaded file name.
FORBIDDEN_FILENAME_CHARS = ("<", ">", ":", '"', "|", "?", "*", "\\", "/")

MAX_FILENAME_LENGTH = 255
MAX_FILE_SIZE_MB = 50  # upload limit
MAX_TXT_SIZE_MB_LEGACY = 100  # older TXT rule
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
VECTOR_SIZE = 768
DEFAULT_LIMIT = 10
TRUNCATE_LENGTH = 1000
TITLE_MAX_LENGTH = 100
LOCAL_TIME_ZONE = "Asia/Ho_Chi_Minh"
NO_TEXT_FOUND = "[No text content found]"
EXTRACTION_ERROR = "[Error extracting content]"
COLLECTION_NAME = "agent_documents"

# Messages
MSG_TEXT_EMPTY = "Text content is empty"
MSG_TEXT_SHORT = "Text content is too short (minimum 10 characters)"
MSG_TEXT_NONPRINTABLE = "Text contains too many non-printable characters"
MSG_FILE_EMPTY = "File is empty"
MSG_TXT_TOO_LARGE_LEGACY = "Text file is too large (max {limit}MB)"
MSG_TXT_SHORT = "Text content too short (minimum {minimum} characters)"
MSG_TXT_EMPTY = "Text file is empty or contains only whitespace"
MSG_FILENAME_EMPTY = "Filename cannot be empty"
MSG_FILENAME_CHARS = "Filename contains invalid characters: ['<', '>', ':', '\"', '|', '?', '*', '\\\\', '/']"
MSG_FILENAME_LONG = "Filename too long (maximum 255 characters)"
MSG_BAD_TYPE = "File type must be 'pdf' or 'txt'"
MSG_PDF_OK = "PDF processed successfully"
MSG_TXT_OK = "TXT processed successfully"
