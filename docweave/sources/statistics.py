"""A1 kept up to date: a stored table's statistics as partial aggregates of its months.

Each month has, for every column, mergeable parts (rows, nulls, bytes and a distinct-count sketch) and the mark of
the files they were taken from.  A refresh lists the table's files, reads only the months whose files have changed
since, and merges the parts of all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from . import tables as TB

PARTS = "position int, column_name string, row_count long, null_count long, data_bytes long, sketch binary, mark string, upload_month string"


def _location(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_statistics/{name}"


def _held(spark: SparkSession, root: str, name: str) -> DataFrame:
    fs, path = TB._fs(spark, _location(root, name))
    return spark.read.schema(PARTS).parquet(_location(root, name)) if fs.exists(path) else spark.createDataFrame([], PARTS)


def _marks(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(upload_month, now): a mark of each month's files; files are added or taken away, never changed."""
    files = TB.files_of(spark, root, name)
    mark = F.concat_ws("-", F.count("*"), F.hex(F.bit_xor(F.xxhash64("file"))), F.hex(F.sum(F.crc32(F.col("file").cast("binary")))))
    return files.groupBy(TB.PARTITION_COL).agg(mark.alias("now"))


def stale_months(spark: SparkSession, root: str, name: str) -> list[str]:
    """Months whose files are not those that their parts were taken from."""
    held = _held(spark, root, name).select(TB.PARTITION_COL, "mark").distinct()
    now = _marks(spark, root, name)
    stale = now.join(held, TB.PARTITION_COL, "full").where(~F.col("now").eqNullSafe(F.col("mark")))
    return sorted(r[0] for r in stale.select(TB.PARTITION_COL).distinct().collect())  # months of a table


def month_parts(table: DataFrame, name: str) -> DataFrame:
    """The parts of every month of ``table`` in one pass: one row a month and column."""
    fields = S.TABLE_SCHEMAS[name].fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        width = TB._fixed_width(f.dataType)
        size = F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) if width is None else F.count(f.name) * width
        sketch = F.hll_sketch_agg(F.xxhash64(f.name), F.lit(12))
        aggs += [F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"), size.cast("long").alias(f"_b{i}"), sketch.alias(f"_s{i}")]
    one = table.groupBy(TB.PARTITION_COL).agg(*aggs)
    rows = ", ".join(f"{i + 1}, '{f.name}', _n{i}, _b{i}, _s{i}" for i, f in enumerate(fields))
    stacked = f"stack({len(fields)}, {rows}) AS (position, column_name, null_count, data_bytes, sketch)"
    return one.selectExpr(TB.PARTITION_COL, "_rows AS row_count", stacked)


def merged(parts: DataFrame, name: str) -> DataFrame:
    """The table's statistics from its months' parts, in the shape of ``tables.table_statistics`` and with
    ``distinct_estimate`` (within some 2 per cent)."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return parts.groupBy("position", "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("data_bytes").alias("data_bytes"), union.alias("distinct_estimate")
    ).select(
        F.lit(name).alias("table_name"),
        "position",
        "column_name",
        "row_count",
        F.lit(len(S.TABLE_SCHEMAS[name].fields)).alias("column_count"),
        "null_count",
        "data_bytes",
        "distinct_estimate",
    )


def refresh_statistics(spark: SparkSession, root: str, name: str) -> list[str]:
    """Takes the parts of the stale months anew (each month's are replaced as a whole); returns those months."""
    stale = stale_months(spark, root, name)
    if stale:
        marks = _marks(spark, root, name)
        rows = TB.rows_of_months(spark, root, name, stale)
        parts = month_parts(rows, name).join(marks.select(TB.PARTITION_COL, F.col("now").alias("mark")), TB.PARTITION_COL)
        columns = [c.split()[0] for c in PARTS.split(", ")]
        parts = parts.select(columns).coalesce(1)  # a few rows for each month
        parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TB.PARTITION_COL).parquet(_location(root, name))
    return stale


def stored_statistics(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A1 of a stored table, refreshed."""
    refresh_statistics(spark, root, name)
    now = _marks(spark, root, name).select(F.col(TB.PARTITION_COL).alias("_month"), "now")
    parts = _held(spark, root, name)  # a month that is gone from the table has no mark
    return merged(parts.join(now, (parts[TB.PARTITION_COL] == now["_month"]) & (parts["mark"] == now["now"]), "left_semi"), name)
