"""Blocked Bloom filters beside a month-partitioned table: which months may hold a key?

A key's hash picks a block of its month's filter and a bit in each of the block's four words.  The filters lie in
``{root}/_filters/{table}`` as rows (kind, month, block, four words); a batch adds rows for the blocks that its keys touch,
and a reader joins only the blocks of its own keys and ors what it finds.  So an append writes as much as the batch
has keys, nothing is rewritten, and no filter is ever held whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: kind of key -> the table's column
KINDS = {"name": "source_file", "hash": "content_hash"}
#: Blocks of a month's filter: at 20 keys a block (20 million a month) about 1 in 200 absent keys passes.  Beyond
#: that more months are read than need be, never fewer.
BLOCKS = 1 << 20
WORDS = ("w0", "w1", "w2", "w3")
SCHEMA = "month string, block int, w0 long, w1 long, w2 long, w3 long, kind string"


def _location(table: str) -> str:
    root, _, name = table.rstrip("/").rpartition("/")
    return f"{root}/_filters/{name}"


def _folder(spark: SparkSession, table: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(_location(table))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, table: str) -> bool:
    fs, path = _folder(spark, table)
    return bool(fs.exists(path))


def _place(kind: str, key: Column) -> list[Column]:
    """(block, four words with one bit each) of a key."""
    block = F.pmod(F.xxhash64(F.lit(kind), key), F.lit(BLOCKS)).cast("int").alias("block")
    bits = F.xxhash64(F.lit("bits"), F.lit(kind), key)
    return [block, *[_bit(F.pmod(F.shiftrightunsigned(bits, 6 * k), F.lit(64))).alias(w) for k, w in enumerate(WORDS)]]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def add(keys: DataFrame, table: str, month: str) -> None:
    """Adds the keys of rows (``month`` and the columns of ``KINDS``) to the filters; null keys are in none."""
    parts = [
        keys.where(F.col(column).isNotNull()).select(F.col(month).alias("month"), *_place(kind, F.col(column)), F.lit(kind).alias("kind"))
        for kind, column in KINDS.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    rows = every.groupBy("kind", "month", "block").agg(*[F.bit_or(w).alias(w) for w in WORDS])
    # in the order of the blocks, so a reader's blocks are found by the files' statistics
    rows.sortWithinPartitions("kind", "block").write.mode("append").partitionBy("kind").parquet(_location(table))


def months(spark: SparkSession, table: str, kind: str, keys: DataFrame) -> list[str]:
    """The months whose filter has one of the keys (a single column): all that hold one, and few others."""
    (column,) = keys.columns
    asked = keys.where(F.col(column).isNotNull()).select(*_place(kind, F.col(column))).distinct()
    asked = asked.select(F.col("block").alias("b"), *[F.col(w).alias(f"a{w}") for w in WORDS])
    held = spark.read.schema(SCHEMA).parquet(_location(table)).where(F.col("kind") == kind)
    hit = held.join(asked.select("b").distinct(), F.col("block") == F.col("b"), "left_semi")
    hit = hit.groupBy("month", "block").agg(*[F.bit_or(w).alias(w) for w in WORDS])
    passed = [F.col(w).bitwiseAND(F.col(f"a{w}")) == F.col(f"a{w}") for w in WORDS]
    match = hit.join(asked, F.col("block") == F.col("b")).where(passed[0] & passed[1] & passed[2] & passed[3])
    return sorted(r[0] for r in match.select("month").distinct().collect())  # months of a table
