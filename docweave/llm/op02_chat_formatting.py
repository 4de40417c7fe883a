"""Chat formatting: collapse of cumulative snapshots by rolling turn-prefix hashes, then rendering.

DataFrame functions only.  A logged conversation that is a turn prefix of a longer one is dropped, of
identical ones the smallest ``conv_id`` stays, and every maximal conversation is rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read

TURN_START = "<|"
TURN_MIDDLE = "|>\n"
TURN_END = "<|end|>\n"


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per turn: its depth in the conversation, the conversation's number of turns, and a
    128-bit hash of all turns up to it (xor of two position-tagged hashes of each turn)."""
    order = [F.asc_nulls_first(c) for c in ("turn", "role", "text")]
    by_conv = W.partitionBy("conv_id")
    so_far = by_conv.orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    tagged = turns.select(
        "conv_id",
        F.row_number().over(by_conv.orderBy(*order)).alias("depth"),
        F.struct(F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias("said"),
    )
    return tagged.select(
        "conv_id",
        "depth",
        F.count("*").over(by_conv).alias("n_turns"),
        F.bit_xor(F.xxhash64(F.lit(1), "depth", "said")).over(so_far).alias("h1"),
        F.bit_xor(F.xxhash64("said", "depth", F.lit(2))).over(so_far).alias("h2"),
    )


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, n_snapshots=1 kept) of the maximal conversations.

    Turns are ordered by (turn, role, text), nulls first; a null role or text is a value of its own.
    Rows without a conv_id belong to no conversation.  ``n_copies`` counts the conversations with
    exactly these turns.  Prefixes are made distinct before the anti-join, so a first turn that opens a
    third of all conversations is one row of it."""
    steps = prefix_hashes(turns.where(F.col("conv_id").isNotNull()))
    prefix = steps.where("depth < n_turns").select("depth", "h1", "h2").distinct()
    whole = (
        steps.where("depth = n_turns")
        .groupBy("depth", "h1", "h2")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    return whole.join(prefix, ["depth", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("depth").cast("long").alias("n_turns"), "n_copies"
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations rendered as one text: ``<|role|>``, newline, text, ``<|end|>``, newline per
    turn (a null role is ``unknown``, a null text empty).  Returns conv_id, n_turns, n_copies, rendered."""
    turns = turns.select("conv_id", "turn", "role", "text")
    kept = collapse_snapshots(turns)
    rendered = F.concat(
        F.lit(TURN_START),
        F.coalesce("role", F.lit("unknown")),
        F.lit(TURN_MIDDLE),
        F.coalesce("text", F.lit("")),
        F.lit(TURN_END),
    )
    # array_sort puts null fields first inside structs, as the prefix order does
    lines = F.array_sort(F.collect_list(F.struct("turn", "role", "text", rendered.alias("line"))))
    return (
        turns.join(kept, "conv_id")
        .groupBy("conv_id")
        .agg(
            F.first("n_turns").alias("n_turns"),
            F.first("n_copies").alias("n_copies"),
            F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("rendered"),
        )
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))


SQL = """
WITH c AS (
  SELECT conv_id, count(*) AS n_turns,
         list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said,
         string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>'
                    || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
u AS (
  SELECT said, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies,
         any_value(rendered) AS rendered
  FROM c GROUP BY said),
prefixes AS (
  SELECT DISTINCT list_slice(said, 1, k) AS said FROM (SELECT said, unnest(range(1, n_turns)) AS k FROM u))
SELECT conv_id, n_turns, n_copies, rendered FROM u WHERE said NOT IN (SELECT said FROM prefixes)
"""
