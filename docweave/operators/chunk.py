"""T1 text chunking and T2 chunk payloads.

Rule (chunk size C, overlap V, 0-based code points): a text of at most C characters is one chunk,
as is.  Otherwise, from ``start = 0`` while ``start < n``: if ``start + C >= n`` the chunk is the
tail ``text[start:]``; else the boundary is the last '.' in ``[start, start + C)`` lying after
``start``, else the last space, else ``start + C``, and the chunk is ``text[start:boundary + 1]``.
Each chunk is emitted stripped (possibly empty).  Next ``start = max(start + C - V, boundary + 1)``,
where the tail step reuses the previous boundary.  This reproduces the reference exactly,
including text that falls between chunks and the extra chunk after a long tail.

Chunking is a per-row flat-map: no shuffle.  Two equal implementations:

* ``method="arrow"`` (default): a flat-map over whole texts in parts of Arrow batches.
* ``method="native"``: the offsets come from a bounded ``aggregate`` over ``sequence`` and the chunks from
  ``posexplode``, all JVM expressions.  It copies its array of spans at every step, so its cost grows with the
  square of a text's chunks: it is a cross-check of the default, not a way to run it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import text as TX
from .batches import flat_map_text

def check_params(chunk_size: int, overlap: int) -> None:
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    if overlap < 0 or overlap >= chunk_size:
        # overlap >= chunk_size would never terminate on a long tail
        raise ValueError("overlap must satisfy 0 <= overlap < chunk_size")


_STOP = re.compile(r"\.")


def _window_end(text: str, stops: list[int], start: int, end: int) -> int:
    """Where the chunk of the window [start, end) ends: after its last full stop, else after its last space, in
    both cases beyond ``start``; else one past the window."""
    k = bisect_left(stops, end)
    if k and stops[k - 1] > start:
        return stops[k - 1] + 1
    space = text.rfind(" ", start + 1, end)
    return (end if space < 0 else space) + 1


def chunk_spans(text: str, chunk_size: int = S.CHUNK_SIZE, overlap: int = S.CHUNK_OVERLAP, mode: str = "reference") -> list[tuple[int, int]]:
    """(start, end) of every chunk before stripping.

    While a whole window fits, it is cut at a break.  What is left then starts every ``chunk_size - overlap``
    characters a chunk that runs to the end.  ``mode="covering"`` instead starts each chunk ``overlap`` characters
    before the last one's end, so no character is left out, and takes one tail."""
    n, step = len(text), chunk_size - overlap
    if n <= chunk_size:
        return [(0, n)]
    stops = [m.start() for m in _STOP.finditer(text)]
    spans, start = [], 0
    while start + chunk_size < n:
        end = _window_end(text, stops, start, start + chunk_size)
        spans.append((start, end))
        start = max(start + step, end) if mode == "reference" else max(start + 1, end - overlap)
    tails = range(start, n, step) if mode == "reference" else [start]
    return spans + [(s, n) for s in tails]


def chunk_strings(text: str, chunk_size: int = S.CHUNK_SIZE, overlap: int = S.CHUNK_OVERLAP) -> list[str]:
    if len(text) <= chunk_size:
        return [text]
    return [text[s:e].strip() for s, e in chunk_spans(text, chunk_size, overlap)]


def _arrow_chunks(df: DataFrame, text_col: str, keys: Sequence[str], chunk_size: int, overlap: int, mode: str) -> DataFrame:
    fields = [
        T.StructField("chunk_index", T.IntegerType(), False),
        T.StructField("chunk_start", T.IntegerType(), False),
        T.StructField("chunk_text", T.StringType(), False),
    ]

    def pieces(text: str | None) -> Iterator[tuple[int, int, str]]:
        if text is None:
            return
        if len(text) <= chunk_size:
            yield 0, 0, text
            return
        for i, (s, e) in enumerate(chunk_spans(text, chunk_size, overlap, mode)):
            yield i, s, text[s:e].strip()

    return flat_map_text(df, text_col, list(keys), fields, pieces)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a one-element ``transform``)."""
    return F.transform(F.array(value), body)[0]


def _utf32_slice(b32: Column, start: Column, length) -> Column:
    """Characters ``[start, start + length)`` of a text held as UTF-32 bytes: a byte slice (no
    re-scan from the start of the text, unlike a code-point ``substring``) and a decode."""
    return F.decode(F.substring(b32, start * 4 + 1, length * 4), "UTF-32")


def chunk_offsets(b32: Column, n: Column, chunk_size: int = S.CHUNK_SIZE, overlap: int = S.CHUNK_OVERLAP) -> Column:
    """array<struct<s:int, e:int>> of chunk spans, as one bounded ``aggregate`` over
    ``sequence`` (native form).  ``b32`` is the text as UTF-32 bytes, ``n`` its length."""
    step = chunk_size - overlap
    span_t = "array<struct<s:int,e:int>>"
    iterations = F.sequence(F.lit(0), (n / F.lit(step)).cast("int") + 2)
    init = F.struct(F.lit(0).alias("start"), F.lit(-1).alias("b"), F.array().cast(span_t).alias("spans"))

    def advance(acc: Column, _i: Column) -> Column:
        start, prev_b = acc["start"], acc["b"]
        end = start + chunk_size

        def inner(reversed_window: Column) -> Column:
            # r = 1-based position from the end; the boundary counts only if it lies after start
            def pick(r: Column, otherwise: Column) -> Column:
                return F.when((r > 0) & (r < chunk_size), start + chunk_size - r).otherwise(otherwise)

            return _let(
                F.instr(reversed_window, "."),
                lambda rd: pick(rd, _let(F.instr(reversed_window, " "), lambda rs: pick(rs, end))),
            )

        def with_boundary(tail: Column) -> Column:
            window = _utf32_slice(b32, start, chunk_size)
            inner_b = F.when(tail, F.lit(-1)).otherwise(_let(F.reverse(window), inner))
            return _let(
                inner_b,
                lambda ib: F.struct(
                    F.greatest(start + step, F.when(tail, prev_b).otherwise(ib) + 1).alias("start"),
                    F.when(tail, prev_b).otherwise(ib).alias("b"),
                    F.concat(acc["spans"], F.array(F.struct(start.alias("s"), F.when(tail, n).otherwise(ib + 1).alias("e")))).alias("spans"),
                ),
            )

        return F.when(start < n, with_boundary(end >= n)).otherwise(acc)

    spans = F.aggregate(iterations, init, advance)["spans"]
    single = F.array(F.struct(F.lit(0).alias("s"), n.alias("e")))
    return F.when(n <= chunk_size, single).otherwise(spans)


def _native_chunks(df: DataFrame, text_col: str, keys: Sequence[str], chunk_size: int, overlap: int) -> DataFrame:
    t = F.col(text_col)
    base = df.select(*keys, t.alias("_t"), F.encode(t, "UTF-32").alias("_b32"))
    base = base.withColumn("_n", (F.octet_length("_b32") / 4).cast("int"))
    spans = chunk_offsets(F.col("_b32"), F.col("_n"), chunk_size, overlap)

    def piece(sp: Column) -> Column:
        cut = TX.py_strip(_utf32_slice(F.col("_b32"), sp["s"], sp["e"] - sp["s"]))
        text = F.when(F.col("_n") <= chunk_size, F.col("_t")).otherwise(cut)
        return F.struct(sp["s"].alias("chunk_start"), text.alias("chunk_text"))

    # Chunk texts are cut before the explode, so the generator never copies the whole document
    # into every output row.  The outer form (equal here: there is always at least one span)
    # keeps Catalyst from inferring a ``size(...) > 0`` filter and pushing that whole computation
    # below a repartition into the scan task.
    pieces = base.select(*keys, F.transform(spans, piece).alias("_chunks"))
    ex = pieces.select(*keys, F.posexplode_outer("_chunks").alias("chunk_index", "_c"))
    return ex.select(*keys, F.col("chunk_index").cast("int").alias("chunk_index"), "_c.chunk_start", "_c.chunk_text")


def chunk_text(
    df: DataFrame,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
    chunk_size: int = S.CHUNK_SIZE,
    overlap: int = S.CHUNK_OVERLAP,
    method: str = "arrow",
    mode: str = "reference",
) -> DataFrame:
    """One row per chunk: ``keys``, chunk_index, chunk_start, chunk_text.  Null texts give no rows.  ``mode`` is
    that of ``chunk_spans`` (the native form knows the reference's only)."""
    check_params(chunk_size, overlap)
    if mode not in ("reference", "covering") or (mode == "covering" and method != "arrow"):
        raise ValueError(f"unknown chunking mode {mode!r} for method {method!r}")
    keys = list(keys)
    src = df.where(F.col(text_col).isNotNull())
    if method == "arrow":
        return _arrow_chunks(src, text_col, keys, chunk_size, overlap, mode)
    if method == "native":
        return _native_chunks(src, text_col, keys, chunk_size, overlap)
    raise ValueError(f"unknown chunking method {method!r}")


def chunk_payload(chunks: DataFrame, upload_ts: Column, source: Column | None = None) -> DataFrame:
    """Point payload columns per chunk: text, chunk_index, upload_timestamp (zone-aware ISO
    text in local time), text_length, plus the caller's source."""
    out = chunks.select(
        *[c for c in chunks.columns if c not in ("chunk_text", "chunk_start")],
        F.col("chunk_text").alias("text"),
        TX.local_iso(upload_ts).alias("upload_timestamp"),
        F.length("chunk_text").cast("int").alias("text_length"),
    )
    if source is not None:
        out = out.withColumn("source", source)
    return out
