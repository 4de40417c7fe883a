"""Object listings and reads over a staged-file root.

A listing is a DataFrame ``(name, size, last_modified, is_dir)`` (+ ``etag`` on request), where
``name`` is the key relative to the root (``pdfs/a.pdf``).  ``list_objects`` builds it from the
``binaryFile`` source without selecting ``content``, so Spark reads only file metadata; the typed
and combined listings are filters and unions over any listing (on disk or a fixture view).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

FILE_TYPES = ("pdf", "txt")
CONTENT_TYPES = {"pdf": "application/pdf", "txt": "text/plain"}


BINARY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def file_system(spark: SparkSession, location: str):
    """The Hadoop file system of a location (with Spark's own credentials) and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def name_under(spark: SparkSession, root: str, path: Column) -> Column:
    """The key of ``path`` relative to ``root``, which may be relative itself or remote."""
    whole = file_system(spark, root)[1].toString().rstrip("/") + "/"
    return F.substring(path, F.lit(len(whole) + 1), F.length(path))


def indexed_files(scan: DataFrame) -> DataFrame:
    """(value): the names, as URIs, in a file scan's index, which the driver holds, empty files among them.  They
    come over as one string: names by the million would be as many calls."""
    spark = scan.sparkSession
    names = spark._jvm.org.apache.hadoop.util.StringUtils.join("\n", scan._jdf.inputFiles())
    return spark.createDataFrame([(n,) for n in names.split("\n") if n], "value string")


def _empty_files(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """The zero-byte files under a scan: Spark's file index lists them, but the scan skips them (and an empty
    upload must fail validation, not vanish).  They are the index's names without the scan's; only they are
    fetched one by one, for their times."""
    every = indexed_files(scan)
    # the index gives URIs; a plus sign stands for itself there
    path = F.url_decode(F.replace(F.col("value"), F.lit("+"), F.lit("%2B")))
    rows = []
    for (name,) in every.select(path.alias("path")).join(scan.select("path"), "path", "left_anti").collect():
        fs, p = file_system(spark, name)
        if fs.exists(p):
            status = fs.getFileStatus(p)
            rows.append((status.getPath().toString(), status.getModificationTime(), status.getLen()))
    empty = spark.createDataFrame(rows, "path string, millis long, length long").where("length = 0")
    return empty.select("path", F.timestamp_millis("millis").alias("modificationTime"), "length", F.lit(b"").alias("content"))


def read_objects(spark: SparkSession, root: str, prefix: str = "", glob: str | None = None, include_empty: bool = True) -> DataFrame:
    """``binaryFile`` rows under ``root/prefix`` with ``name`` relative to ``root``; zero-byte files are added
    back (the scan itself skips them).  Listed and read by Spark's own file scan on any Hadoop file system: the
    index of names and sizes is the driver's, bytes are read by tasks.  No such folder, no rows."""
    base = root.rstrip("/")
    location = base + "/" + prefix.lstrip("/") if prefix else base
    fs, path = file_system(spark, location)
    if not fs.exists(path):
        return spark.createDataFrame([], BINARY_SCHEMA).withColumn("name", F.col("path"))
    reader = spark.read.format("binaryFile").schema(BINARY_SCHEMA).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(location)
    if include_empty:
        df = df.unionByName(_empty_files(spark, df))
    return df.withColumn("name", name_under(spark, root, F.col("path")))


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``binaryFile`` rows of a bounded list of paths; gone ones are passed over."""
    here = []
    for path in paths:
        fs, p = file_system(spark, path)
        if fs.exists(p):
            here.append("".join("\\" + c if c in "{}[]*?\\" else c for c in path))
    if not here:
        return spark.createDataFrame([], BINARY_SCHEMA)
    return spark.read.format("binaryFile").schema(BINARY_SCHEMA).option("ignoreMissingFiles", "true").load(here)


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", include_metadata: bool = True, include_etag: bool = False
) -> DataFrame:
    """Listing under a prefix, recursive.  ``content`` is only read when an etag (MD5) is asked."""
    df = read_objects(spark, root, prefix)
    if not include_metadata:
        return df.select("name")
    cols = [
        "name",
        F.col("length").alias("size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        F.lit(False).alias("is_dir"),
    ]
    if include_etag:
        cols.append(F.md5("content").alias("etag"))
    return df.select(*cols)


def listing_from_staged(staged: DataFrame) -> DataFrame:
    """Listing view of staged-file rows (fixture): object_name, size, upload time, MD5 etag."""
    return staged.select(
        F.col("object_name").alias("name"),
        F.col("file_size").alias("size"),
        F.col("upload_datetime").alias("last_modified"),
        F.md5("content").alias("etag"),
        F.lit(False).alias("is_dir"),
    )


def typed_listing(listing: DataFrame, file_type: str) -> DataFrame:
    """Objects under ``{type}s/``."""
    return listing.where(F.col("name").startswith(f"{file_type}s/"))


def listing_counts(listing: DataFrame) -> DataFrame:
    """A5 for listings: ``total_count`` per type prefix, as a grouped aggregate (never a global
    window, which would pull all rows into one partition)."""
    t = F.regexp_extract("name", r"^(pdf|txt)s/", 1)
    return listing.where(t != "").groupBy(t.alias("type")).agg(F.count(F.lit(1)).alias("total_count"))


def catalog_all(listing: DataFrame, file_type: str | None = None) -> DataFrame:
    """S3: both typed listings with a ``type`` column (one scan of the listing; ``type_order`` 0 for
    PDF rows, which come first); optional case-insensitive type filter; an unknown type gives an
    empty result."""
    t = F.regexp_extract("name", r"^(pdf|txt)s/", 1)
    out = listing.withColumn("type", t).where(F.col("type") != "")
    if file_type is not None:
        out = out.where(F.col("type") == F.lit(file_type.lower()))
    return out.withColumn("_type_ord", F.when(F.col("type") == "pdf", F.lit(0)).otherwise(F.lit(1)))


def file_info(listing: DataFrame, file_type: str, filename: str) -> DataFrame:
    """Metadata of ``{type}s/{filename}``; the type must be pdf or txt."""
    if file_type not in FILE_TYPES:
        raise ValueError(S.MSG_BAD_TYPE)
    return listing.where(F.col("name") == F.lit(f"{file_type}s/{filename}"))


def silver_read(silver: DataFrame, path_col: str = "path", bytes_col: str | None = None, text_col: str = "text") -> DataFrame:
    """Silver text read as UTF-8; unreadable (invalid UTF-8) or empty -> skipped.  Accepts raw
    bytes (from ``binaryFile``) or already-decoded text."""
    if bytes_col is not None:
        text = F.try_validate_utf8(F.col(bytes_col).cast("string"))
    else:
        text = F.col(text_col)
    out = silver.select(F.col(path_col).alias("path"), text.alias("text"))
    return out.where(F.col("text").isNotNull() & (F.col("text") != ""))
