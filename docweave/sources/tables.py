"""Document tables (parquet, month-partitioned) under a warehouse root, and the
table-level reads: full scan, page, schema, statistics.

Tables live at ``{root}/{name}`` partitioned by ``upload_month`` (the reference's month transform
on ``upload_datetime``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.records import upload_month
from ..session import reliable_checkpoint, spread
from . import key_filters as KF
from . import listing as LS

PARTITION_COL = "upload_month"


def _path(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """Any failure to find the table counts as absent."""
    try:
        fs, p = _fs(spark, _path(root, name))
        return bool(fs.exists(p))
    except Exception:  # noqa: BLE001
        return False


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Table directories under the root (metadata only)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith("_"))


def ensure_tables(spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None) -> None:
    """Create each table (empty, with its schema and partition column) when absent."""
    for name, schema in (schemas or S.TABLE_SCHEMAS).items():
        if not table_exists(spark, root, name):
            empty = spark.createDataFrame([], schema).withColumn(PARTITION_COL, upload_month(F.col("upload_datetime")))
            empty.write.mode("ignore").partitionBy(PARTITION_COL).parquet(_path(root, name))


def stored_schema(name: str) -> T.StructType:
    return T.StructType(list(S.TABLE_SCHEMAS[name].fields) + [T.StructField(PARTITION_COL, T.StringType())])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy full scan with the declared schema (never inferred)."""
    reader = spark.read
    if name in S.TABLE_SCHEMAS:
        reader = reader.schema(stored_schema(name))
    return spread(reader.parquet(_path(root, name)))


def files_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(file, upload_month) of a stored table's data files, as the scan's file index has them: URIs, the same as
    ``_metadata.file_path``."""
    files = LS.indexed_files(spark.read.schema(stored_schema(name)).parquet(_path(root, name)))
    return files.select(F.col("value").alias("file"), F.regexp_extract("value", f"/{PARTITION_COL}=([^/]*)/", 1).alias(PARTITION_COL))


def plan_append(records: DataFrame, present: DataFrame) -> DataFrame:
    """The rows of a batch that a table does not hold yet, with their versions.

    A row is a document's bytes under a name: (``content_hash``, ``source_file``), whatever the run time, so a
    batch replayed by a later run adds nothing, while the same bytes under two names keep both rows.  Of rows
    that repeat the pair inside the batch the earliest stays.  A name uploaded again with new bytes gets the
    next ``version``.  ``present`` needs the two key columns and ``version``."""
    key = ["content_hash", "source_file"]
    earliest = Window.partitionBy(*key).orderBy("upload_datetime", "file_id")
    rows = records.withColumn("_n", F.row_number().over(earliest)).where("_n = 1").drop("_n")
    fresh = rows.join(present.select(*key).distinct(), on=key, how="left_anti")
    last = present.groupBy("source_file").agg(F.max("version").alias("_last"))
    order = Window.partitionBy("source_file").orderBy("upload_datetime", "content_hash")
    version = (F.coalesce("_last", F.lit(0)) + F.row_number().over(order)).cast("int")
    return fresh.join(last, on="source_file", how="left").withColumn("version", version).select(*records.columns)


def touched_months(spark: SparkSession, root: str, name: str, kind: str, keys: DataFrame) -> list[str]:
    """The months of a table that may hold one of ``keys`` (a single column), by the filters beside the table.  A
    table written before it had filters gets them first."""
    if not KF.exists(spark, _path(root, name)):
        table = read_table(spark, root, name)
        KF.add(table.select(PARTITION_COL, *KF.KINDS.values()), _path(root, name), PARTITION_COL)
    return KF.months(spark, _path(root, name), kind, keys)


def rows_of_months(spark: SparkSession, root: str, name: str, months: Sequence[str]) -> DataFrame:
    """The table's rows of some months; the files of the others are not read."""
    return read_table(spark, root, name).where(F.col(PARTITION_COL).isin(list(months)))


def append_documents(records: DataFrame, root: str, name: str) -> DataFrame:
    """One append for the whole batch; returns the rows written (see ``plan_append``).  Of the table only
    the key columns of the batch's own file names are read, in the months whose filter has one of them."""
    spark = records.sparkSession
    schema = S.TABLE_SCHEMAS[name]
    rows = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    held = ["content_hash", "source_file", "version"]
    if table_exists(spark, root, name):
        names = rows.select("source_file").distinct()
        months = touched_months(spark, root, name, "name", names)
        present = rows_of_months(spark, root, name, months).select(*held).join(names, "source_file", "left_semi")
    else:
        present = rows.select(*held).limit(0)
    # kept in the shared folder: what is written is what is returned, even though the table changes
    rows = reliable_checkpoint(plan_append(rows, present))
    out = rows.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])
    out = out.withColumn(PARTITION_COL, upload_month(F.col("upload_datetime")))
    # the filters come first: a key that never gets to the table costs a read, a missing one would cost a duplicate
    KF.add(out.select(PARTITION_COL, *KF.KINDS.values()), _path(root, name), PARTITION_COL)
    # Rebalance by month: few, large files per month, and AQE splits a month that holds most
    # of the batch over several writer tasks instead of one.
    out.hint("rebalance", PARTITION_COL).write.mode("append").partitionBy(PARTITION_COL).parquet(_path(root, name))
    return rows


def content_conflicts(spark: SparkSession, root: str, name: str, hashes: DataFrame) -> DataFrame:
    """(content_hash, file_id, source_file) of a table's rows that hold one of the ``content_hash``es; of several the
    first by upload time, id and name.  Only months whose filter has one of the hashes are read."""
    wanted = hashes.select("content_hash").distinct()
    if not table_exists(spark, root, name):
        return wanted.limit(0).select("content_hash", F.lit("").alias("file_id"), F.lit("").alias("source_file"))
    rows = rows_of_months(spark, root, name, touched_months(spark, root, name, "hash", wanted))
    found = rows.select("content_hash", "upload_datetime", "file_id", "source_file").join(wanted, "content_hash", "left_semi")
    first = found.groupBy("content_hash").agg(F.min(F.struct("upload_datetime", "file_id", "source_file")).alias("first"))
    return first.select("content_hash", "first.file_id", "first.source_file")


def total_order(df: DataFrame) -> list[str]:
    """Upload time and id are shared by equal bytes under two names in one batch; with the file name no two
    rows of a table are alike."""
    return [c for c in ("upload_datetime", "file_id", "source_file") if c in df.columns]


def rows_of(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key columns are in ``keys``; a null is equal to a null."""
    held = keys.select(*[F.col(c).alias(f"_of_{c}") for c in key])
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    return df.join(held, on, "left_semi")


#: An offset beyond this is found by counts of key ranges; a range is split until it holds no more rows than this.
DEEP = 10_000
SPLITS = 64


_NUMBERS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType)


def _digits(df: DataFrame, c: str, longest: int) -> list[Column]:
    """Numbers whose order, one after the other, is that of a key column: a time in microseconds, a string by six
    bytes at a time up to the ``longest``, then its length (a zero byte counts like the end).  A null comes before
    everything."""
    kind, low = df.schema[c].dataType, F.lit(-(1 << 62))
    if isinstance(kind, T.StringType):
        raw = F.hex(F.encode(F.col(c), "UTF-8"))
        parts = [F.conv(F.rpad(F.substring(raw, at + 1, 12), 12, "0"), 16, 10).cast("long") for at in range(0, 2 * longest, 12)]
        return [F.coalesce(x, F.lit(-1)) for x in (*parts, F.octet_length(c).cast("long"))]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [F.coalesce(_micros(c, kind), low)]
    return [F.coalesce((F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c)).cast("long"), low)]


def _micros(c: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(c))
    # without a zone: the time since 1970 as an interval, whatever the session's zone is
    since = F.col(c) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.extract(F.lit("DAY"), since).cast("long")
    seconds = (days * 24 + F.extract(F.lit("HOUR"), since)) * 3600 + F.extract(F.lit("MINUTE"), since) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), since) * 1_000_000).cast("long")


def _seek(df: DataFrame, key: Sequence[str], offset: int, bound: int) -> tuple[Column, int]:
    """(condition, rest): the rows that fit the condition, less the first ``rest`` of them in the key's order, are
    those after the first ``offset``.

    The key's leading number is cut at its quantiles and the ranges are counted; the range that holds the offset is
    cut again until it has at most ``bound`` rows, by the next number where all its rows share one.  Every step is an
    aggregation; no task sorts or holds more than its own partial counts."""
    after, here, rest = F.lit(False), F.lit(True), offset
    steps = [k / SPLITS for k in range(1, SPLITS)]
    for c in key:
        longest = 0
        if isinstance(df.schema[c].dataType, T.StringType):
            longest = df.where(here).agg(F.coalesce(F.max(F.octet_length(c)), F.lit(0))).first()[0]
        for digit in _digits(df, c, longest):
            low, high = None, None  # the current range of this digit: low < digit <= high
            while True:
                inside = here
                if low is not None:
                    inside = inside & (digit > low)
                if high is not None:
                    inside = inside & (digit <= high)
                rows = df.where(inside).select(digit.alias("d"))
                cuts, least, most, n = rows.agg(F.percentile_approx("d", steps, 10_000), F.min("d"), F.max("d"), F.count("*")).first()
                if n <= bound:
                    return after | (here & (F.lit(True) if low is None else digit > low)), rest
                if least == most:
                    break  # one value: the next digit tells its rows apart
                cuts = sorted({x for x in cuts if x < most} | {least})
                place = F.aggregate(F.array(*[F.lit(x).cast("long") for x in cuts]), F.lit(0), lambda acc, x: acc + (x < F.col("d")).cast("int"))
                counts = dict(rows.groupBy(place.alias("b")).count().collect())  # at most SPLITS + 1
                k = 0
                while k < len(cuts) and rest >= counts.get(k, 0):
                    rest -= counts.get(k, 0)
                    k += 1
                low, high = (cuts[k - 1] if k else low), (cuts[k] if k < len(cuts) else high)
            after, here = after | (here & (digit > least)), here & (digit == least)
    return after | here, rest


def table_page(
    df: DataFrame, limit: int | None = None, offset: int = 0, order: list[str] | None = None, deep: int = DEEP
) -> DataFrame:
    """Rows after skipping ``offset`` (only if > 0), at most ``limit`` (None = all), in a total
    order.  Negative values are rejected.

    Only the order's columns are sorted and counted off; whole rows are joined back to the page's keys, and a
    page without a limit is everything after its last skipped key, so no task gets the table.  An offset beyond
    ``deep`` is first narrowed down to a key range of at most that many rows by counts (``_seek``)."""
    offset = offset or 0
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("limit and offset must be non-negative")
    key = order or total_order(df)
    told_apart = (T.StringType, T.TimestampType, T.TimestampNTZType, *_NUMBERS)
    if offset > deep and all(isinstance(df.schema[c].dataType, told_apart) for c in key):
        reach, offset = _seek(df, key, offset, max(1, deep))
        df = df.where(reach)
    if limit is not None:
        page = df.select(*key).orderBy(*key).offset(offset).limit(limit)
        return rows_of(df, page, key).orderBy(*key).limit(limit)
    if offset:
        skipped = df.select(F.struct(*key).alias("k")).orderBy("k").limit(offset)
        df = df.where(F.struct(*key) > skipped.agg(F.max("k")).scalar())
    return df.orderBy(*key)


def page_after(df: DataFrame, last_key: tuple | None, limit: int, order: Sequence[str] | None = None) -> DataFrame:
    """Keyset paging: the next ``limit`` rows after ``last_key`` (a value for each column of the total order);
    cost independent of depth.  Nulls come first, also in ``last_key``."""
    key = list(order or total_order(df))
    out = df
    if last_key is not None:
        if len(last_key) != len(key):
            raise ValueError(f"the last key needs {key}")
        later, same = F.lit(False), F.lit(True)
        for c, v in zip(key, last_key, strict=True):
            above = F.col(c).isNotNull() if v is None else F.coalesce(F.col(c) > F.lit(v), F.lit(False))
            later, same = later | (same & above), same & F.col(c).eqNullSafe(F.lit(v))
        out = out.where(later)
    page = out.select(*key).orderBy(*key).limit(limit)
    return rows_of(out, page, key).orderBy(*key).limit(limit)


def page_counts(df: DataFrame, limit: int | None, offset: int = 0) -> DataFrame:
    """A5 for pages: total_rows (one count) and returned_rows, offset, limit."""
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    after = F.greatest(F.col("total_rows") - F.lit(offset), F.lit(0))
    returned = after if limit is None else F.least(after, F.lit(limit))
    return total.select(
        "total_rows",
        returned.cast("long").alias("returned_rows"),
        F.lit(offset).alias("offset"),
        F.lit(limit).cast("int").alias("limit"),
    )


def table_schema(table: DataFrame) -> DataFrame:
    """(id, name, type, required) per column of a stored table, from its metadata: the declared field ids
    and requirements travel with the files (a scan itself reports every column as optional)."""
    rows = [
        (f.metadata["id"], f.name, f.dataType.simpleString(), f.metadata["required"])
        for f in table.schema.fields
        if "id" in f.metadata
    ]
    return table.sparkSession.createDataFrame(rows, "id int, name string, type string, required boolean")


def _fixed_width(dtype: T.DataType) -> int | None:
    widths = {T.LongType: 8, T.IntegerType: 4, T.TimestampNTZType: 8, T.TimestampType: 8, T.DoubleType: 8, T.BooleanType: 1}
    for k, v in widths.items():
        if isinstance(dtype, k):
            return v
    return None


def table_statistics(df: DataFrame, table_name: str) -> DataFrame:
    """A1: one aggregation pass -> one row per column: row_count, column_count, null_count,
    data_bytes (UTF-8 bytes of strings, fixed width of numbers/timestamps)."""
    fields = [f for f in df.schema.fields]
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"))
        width = _fixed_width(f.dataType)
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)).cast("long").alias(f"_b{i}"))
        elif width is not None:
            aggs.append((F.count(f.name) * width).cast("long").alias(f"_b{i}"))
        else:
            aggs.append(F.lit(None).cast("long").alias(f"_b{i}"))
    one = df.agg(*aggs)
    stack_args = ", ".join(f"{i + 1}, '{f.name}', _n{i}, _b{i}" for i, f in enumerate(fields))
    long = one.selectExpr("_rows", f"stack({len(fields)}, {stack_args}) AS (position, column_name, null_count, data_bytes)")
    return long.select(
        F.lit(table_name).alias("table_name"),
        F.col("position").cast("int").alias("position"),
        "column_name",
        F.col("_rows").alias("row_count"),
        F.lit(len(fields)).alias("column_count"),
        F.col("null_count").cast("long").alias("null_count"),
        "data_bytes",
    )
