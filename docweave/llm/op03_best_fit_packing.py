"""Best-fit packing of token sequences: large pieces are matched greedily, at most two to a sequence,
and smaller pieces best-fit the gaps.

A piece's length is an integer up to the capacity, so the whole packing is decided on the histogram of
lengths (at most ``capacity`` counts on the driver, whatever the corpus holds): it yields patterns, each
"so many sequences with these lengths".  Spark then numbers the pieces of each length and joins every
piece with the pattern slot of its number, so no task holds more than its own share of pieces."""

from __future__ import annotations

import re
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, read

CAPACITY = 1024
END_ID = 2
#: Pieces of one length are numbered in independent groups of about this many, 64 groups at least, so a
#: hot length is no hot task.
GROUP_PIECES = 500_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: Text on which both tokenizer libraries are known to split alike.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*")
_SPECIAL = "<|endoftext|>"


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def _encoder(files: tuple[str, str | None]):
    """Token ids of a text by the ``tokenizers`` file.  The optional second file holds the same vocabulary
    as ranks: plain Latin-1 text, where the two give equal ids, is encoded with it several times faster."""
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(files[0])
    if not files[1]:
        return lambda text: full.encode(text, add_special_tokens=False).ids
    import base64

    import public_tokenizers
    import tiktoken

    with open(files[1], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return fast.encode_ordinary(text)
        return full.encode(text, add_special_tokens=False).ids

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only longer documents are cut, the first piece is the rest."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, files: tuple[str, str | None], capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: the document's ids (a null text has none) and the end id, cut to capacity."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(files)
        for batch in batches:
            out: list[tuple] = []
            ids_out: list[np.ndarray] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.array(encode(text or "") + [end_id], "<u4")
                for k, (at, n) in enumerate(cut(len(ids), capacity)):
                    own = ids[at : at + n]
                    out.append((doc_id, k, at, n, zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids_out.append(own.astype(np.int32))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            data = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                data.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(data, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, PIECES + ", ids array<int>" * with_ids)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, pieces of it), ...]) that hold every piece exactly once.

    Pieces over a third of the capacity: from the longest down, each class is matched with the longest
    class that still fits beside it, two to a sequence.  Smaller ones, from the longest down, go where the
    least room is left over; those that fit nowhere open sequences of their own.  Whole classes move at
    once, so the work depends on the capacity, not on the number of pieces."""
    left = {s: n for s, n in histogram.items() if n > 0}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("a piece's length is from 1 to the capacity")
    bins: list[tuple[int, int, list[tuple[int, int]]]] = []  # (gap, sequences, contents), sorted by gap
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left.get(s):
            mate = next((m for m in large if m <= min(s, capacity - s) and left.get(m, 0) > (m == s)), None)
            if mate is None:
                insort(bins, (capacity - s, left.pop(s), [(s, 1)]))
            elif mate == s:
                pairs = left[s] // 2
                left[s] -= 2 * pairs
                insort(bins, (capacity - 2 * s, pairs, [(s, 2)]))
            else:
                pairs = min(left[s], left[mate])
                left[s] -= pairs
                left[mate] -= pairs
                insort(bins, (capacity - s - mate, pairs, [(s, 1), (mate, 1)]))
    for s in sorted((s for s in left if left[s] and 3 * s <= capacity), reverse=True):
        while left[s]:
            at = next((k for k, b in enumerate(bins) if b[0] >= s), None)
            if at is None:  # new sequences, as full of this length as they go
                each = capacity // s
                count, rest = divmod(left[s], each)
                if count:
                    insort(bins, (capacity - each * s, count, [(s, each)]))
                if rest:
                    insort(bins, (capacity - rest * s, 1, [(s, rest)]))
                left[s] = 0
                break
            gap, count, held = bins.pop(at)
            each = min(gap // s, left[s])
            full = min(count, left[s] // each)
            insort(bins, (gap - each * s, full, [*held, (s, each)]))
            if count > full:
                insort(bins, (gap, count - full, held))
            left[s] -= each * full
    return [(count, held) for _, count, held in bins]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, pieces per sequence, first sequence, first offset) of every run of
    equal pieces in a pattern."""
    out, used, sequence = [], {}, 0
    for count, held in patterns:
        offset = 0
        for s, each in held:
            first = used.get(s, 0)
            used[s] = first + count * each
            out.append((s, first, used[s], each, sequence, offset))
            offset += s * each
        sequence += count
    return out


def number_pieces(pieces: DataFrame, count: int) -> DataFrame:
    """``pieces`` (so many) with ``number``: from 0 without gaps within each length.  The pieces of each
    length are numbered in hash groups whose sizes are then summed up."""
    groups = max(64, count // GROUP_PIECES)
    grouped = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = grouped.groupBy("length", "g").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("g")) - F.col("n")
    starts = sizes.select("length", "g", before.alias("before"))
    starts = broadcast_if_small(starts, min(count, groups * CAPACITY))
    inside = W.partitionBy("length", "g").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = grouped.withColumn("k", F.row_number().over(inside) - 1).join(starts, ["length", "g"])
    return ranked.withColumn("number", F.col("before") + F.col("k")).drop("g", "k", "before")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0 in every sequence)."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    spark = pieces.sparkSession
    table = slots(plan_packing(histogram, capacity))
    # bounded by the capacity: each step of the plan splits at most two classes
    plan = spark.createDataFrame(table, "s long, first long, last long, each long, sequence long, at long")
    lengths = plan.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("first", "last", "each", "sequence", "at"))).alias("runs"))
    numbered = number_pieces(pieces, sum(histogram.values()))
    joined = numbered.join(F.broadcast(lengths), numbered["length"] == lengths["s"])
    run = F.element_at(F.filter("runs", lambda x: (x["first"] <= F.col("number")) & (F.col("number") < x["last"])), 1)
    placed = joined.withColumn("run", run).withColumn("place", F.col("number") - F.col("run.first"))
    sequence = F.col("run.sequence") + F.floor(F.col("place") / F.col("run.each"))
    offset = F.col("run.at") + (F.col("place") % F.col("run.each")) * F.col("length")
    return placed.select(*pieces.columns, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def pack_documents(docs: DataFrame, files: tuple[str, str | None] | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens; one row per piece (``with_ids``
    adds its ids).

    A document is its token ids and the end id; a null or empty text is the end id alone.  Longer ones are
    cut into full pieces after a first piece with the rest.  Only doc_id and text are read.  Rows with equal
    or null doc_id are packed each on their own; of equal rows it is undefined which gets which place, and
    indifferent.  No documents give no rows.  Tokenizing is done once: the narrow pieces are checkpointed."""
    pieces = checkpointed(tokenized_pieces(docs, files or default_tokenizer(), capacity, end_id, with_ids))
    return pack(pieces, capacity)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
