"""Q1 content search and Q2 document lookup over the document tables.

Both read every table lazily and let Catalyst prune columns and push ``file_id =`` down to the
parquet scan.  Results are always ordered by a total key (table order, upload time, file id)
before a limit, so that a result is reproducible, unlike a scan-order slice.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import reliable_checkpoint
from ..sources.tables import rows_of


def check_java_regex(spark: SparkSession, pattern: str) -> None:
    """Fail fast on the driver for a pattern the executors could not compile."""
    try:
        spark._jvm.java.util.regex.Pattern.compile(pattern)
    except Exception as exc:  # py4j wraps PatternSyntaxException
        raise ValueError(f"invalid search pattern {pattern!r}") from exc


def search_pattern(query: str) -> str:
    """A Python search pattern for the JVM: case-insensitive, with Unicode cases and classes, and Python's
    spelling of named groups translated."""
    java = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", query)
    java = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", java)
    return "(?iuU)" + java


def content_matches(content: Column, query: str) -> Column:
    """P10: case-insensitive (Unicode) regex search; null content is no match."""
    return F.coalesce(content.rlike(search_pattern(query)), F.lit(False))


def key_of(tables: Mapping[str, DataFrame]) -> list[str]:
    """The columns of a total order: one batch can hold the same bytes under two names, so upload time and id
    are not enough; no two rows of a document table share all three."""
    key = ["upload_datetime", "file_id", "source_file"]
    return [c for c in key if all(c in df.columns for df in tables.values())]


def _tagged_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = [
        df.withColumn("source_table", F.lit(name)).withColumn("_table_ord", F.lit(i))
        for i, (name, df) in enumerate(tables.items())
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def search_documents(
    tables: Mapping[str, DataFrame], query: str, limit: int = S.DEFAULT_LIMIT, silver: DataFrame | None = None
) -> DataFrame:
    """Rows of each table (in the given order) whose ``content`` matches ``query``, tagged with
    ``source_table``; the first ``limit`` by (table order, upload_datetime, file_id).

    PDF rows hold the silver path in ``content``.  By default that path is what is searched (the
    table contract as is); with ``silver`` (``path``, ``text``) the PDF rows are matched on their
    extracted text instead, joined by path (an equi-join; the rows keep their columns)."""
    if limit is None or limit < 0:
        raise ValueError("limit must be a non-negative integer")
    first = next(iter(tables.values()))
    check_java_regex(first.sparkSession, search_pattern(query))
    hits = {}
    for name, df in tables.items():
        if "content" not in df.columns:
            continue
        if silver is not None and name == S.PDF_TABLE:
            text = silver.select(F.col("path").alias("_path"), F.col("text").alias("_search_text"))
            text = text.where(content_matches(F.col("_search_text"), query))  # filter before the join
            hits[name] = df.join(text, df["content"] == text["_path"], "left_semi")
        else:
            hits[name] = df.where(content_matches(F.col("content"), query))
    if not hits:
        return first.limit(0)
    # the first rows are found on their keys, and only those rows' contents are fetched
    key = key_of(hits)
    order = ["_table_ord", *key]
    top = _tagged_union({name: df.select(*key) for name, df in hits.items()}).orderBy(*order).limit(limit)
    rows = _tagged_union({name: tables[name] for name in hits})
    return rows_of(rows, top, [*order, "source_table"]).orderBy(*order).limit(limit).drop("_table_ord")


def document_by_id(tables: Mapping[str, DataFrame], file_id: str | Column) -> DataFrame:
    """Q2: the first table (in order) holding ``file_id`` wins; no hit gives no row."""
    wanted = F.lit(file_id) if isinstance(file_id, str) else file_id
    u = _tagged_union({n: df.where(F.col("file_id") == wanted) for n, df in tables.items()})
    return u.orderBy("_table_ord", *key_of(tables)).limit(1).drop("_table_ord")


#: Rows looked up whose keys are broadcast to the tables' scans (some 100 bytes each).
MAX_BROADCAST_KEYS = 200_000


def documents_by_ids(tables: Mapping[str, DataFrame], requests: DataFrame) -> DataFrame:
    """Q2, batch form: one row per requested ``file_id``; ``source_table`` and the document columns
    are null when no table holds it (or the id is null).

    The winning row of each id is found on its key alone: one aggregation over the tables' key columns with a
    marker row for each request, combined before its shuffle, so a hot id is one row a task.  The winners' keys
    are counted; up to a bound they are broadcast to the tables, so no content is shuffled, beyond it Spark joins
    them by shuffle."""
    key = key_of(tables)
    rest = [c for c in key if c != "file_id"] + ["source_table"]
    keys = _tagged_union({name: df.select(*key) for name, df in tables.items()})
    best = F.struct("_table_ord", *rest)
    asked = requests.select("file_id").select("file_id", F.lit(True).alias("_asked"), F.lit(None).alias("_best"))
    held = keys.select("file_id", F.lit(False).alias("_asked"), best.alias("_best"))
    first = (
        asked.unionByName(held)
        .groupBy("file_id")
        .agg(F.max("_asked").alias("_asked"), F.min("_best").alias("_best"))
        .where("_asked")
        .select("file_id", (F.col("_best").isNotNull() & F.col("file_id").isNotNull()).alias("_found"), "_best")
    )
    first = reliable_checkpoint(first)
    winners = first.where("_found").select(F.col("file_id").alias("_of_file_id"), *[F.col(f"_best.{c}").alias(f"_of_{c}") for c in rest])
    if winners.count() <= MAX_BROADCAST_KEYS:
        winners = F.broadcast(winners)
    rows = _tagged_union(tables).drop("_table_ord")
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ["file_id", *rest]]
    found = rows.join(winners, on, "left_semi")
    return found.unionByName(first.where("not _found").select("file_id"), allowMissingColumns=True)
