"""Suffix-array dedup: byte strings of 50 that also start in a document with a smaller doc_id are removed.

There are no rounds of Spark sorts over (position, rank) pairs and no global reranking.  Each task names strings
by hash, doubling offsets (8, 16, 20 bytes) over its own text, so equal strings have equal names anywhere.
A window of 50 bytes stands under the smallest of its 20-byte names (a minimizer); names that occur once are
dropped, and the windows under a shared one are compared by one 50-byte hash name, sorted in Arrow groups
(``repeats.py``)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, odd_factors, read, shielded
from .repeats import find_repeats, ranges, sliding_min, window_mask, window_runs

WIDTH = 50
SAMPLE = 20  # bytes of a sampled position's first global rank
#: Positions ranked at once, so a very long text needs no more memory than a short one.
STEP = 1 << 18

_A, _B = (np.uint64(x) for x in odd_factors(2))


_BYTE_NAMES = mix(np.arange(256, dtype=np.uint64), 5)


def pair(x: np.ndarray, offset: int) -> np.ndarray:
    """Ranks of longer strings: a name of (rank, rank ``offset`` further on) at every position."""
    a, b = x[: len(x) - offset], x[offset:]
    h = (a ^ (a >> np.uint64(29))) * _A + (b ^ (b >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(31))


def ranks(buf: np.ndarray, length: int) -> np.ndarray:
    """Names of the strings of ``length`` (8 or more) bytes at every position, by prefix doubling."""
    n = len(buf) - 7
    if n <= 0:
        return np.zeros(0, np.uint64)
    rank, known = np.ndarray((n,), "<u8", np.ascontiguousarray(buf), 0, (1,)).copy(), 8
    while known < length:
        offset = min(known, length - known)
        rank, known = pair(rank, offset), known + offset
    return rank


class ByteWindows:
    """Windows of 50 bytes, anchored at the sampled 20-byte string with the smallest name in them."""

    width = WIDTH
    results = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"}

    def load(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def segments(self, buf: np.ndarray, bounds: np.ndarray, use: np.ndarray) -> Iterator[tuple]:
        valid = window_mask(bounds, use, WIDTH)
        for at in range(0, len(buf), STEP):
            part = buf[at : at + STEP + WIDTH - 1]
            if len(part) < WIDTH:
                break
            least = sliding_min(mix(ranks(part, SAMPLE)), WIDTH - SAMPLE + 1)
            start, count = window_runs(least, valid[at : at + len(least)])
            yield least[start], start + at, count

    def prepare(self, buf: np.ndarray) -> np.ndarray:
        return buf

    def values(self, buf: np.ndarray) -> np.ndarray:
        return _BYTE_NAMES[buf]

    def payload(self, buf: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
        return zstandard.compress(buf[ranges(start, count + WIDTH - 1)].tobytes(), 1)

    def unload(self, data: bytes, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(zstandard.decompress(data), np.uint8), count + WIDTH - 1

    def names(self, load: np.ndarray, size: np.ndarray, count: np.ndarray) -> np.ndarray:
        return ranks(load, WIDTH)[ranges(np.cumsum(size) - size, count)]

    def result(self, text: bytes, buf: np.ndarray, a: int, b: int, cover: np.ndarray) -> tuple:
        removed = int(cover.sum())
        spans = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
        return b - a, removed, spans, text if not removed else buf[a:b][~cover].tobytes()


class DigestWindows(ByteWindows):
    results = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}

    def result(self, *args) -> tuple:
        *numbers, kept = super().result(*args)
        return *numbers, hashlib.sha256(kept).hexdigest()


class TextWindows(ByteWindows):
    """Cuts whole characters only: one that a removed run covers in part stays."""

    results = {"kept_text": "string", "n_removed": "long"}

    def result(self, text: bytes, buf: np.ndarray, a: int, b: int, cover: np.ndarray) -> tuple:
        if not cover.any():
            return text.decode(errors="replace"), 0
        own = buf[a:b]
        head = np.flatnonzero((own & 0xC0) != 0x80)  # first bytes of characters
        gone = np.minimum.reduceat(cover, head)
        keep = ~np.repeat(gone, np.diff([*head, len(own)]))
        return own[keep].tobytes().decode(errors="replace"), int((~keep).sum())


def remove_repeated_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with every repeated 50-byte string cut from ``text`` (whole characters) and ``n_chars``, where
    there is such a column, counted anew.  All rows stay, a text that is all repeats becomes empty and a
    null text stays null."""
    inner, names = shielded(docs, list(TextWindows.results))
    done = find_repeats(inner, TextWindows())
    text = F.when(F.col("text").isNotNull(), F.col("kept_text")).alias("text")
    n_chars = F.when(F.col("text").isNotNull(), F.length("kept_text").cast("long")).alias("n_chars")
    return done.select(*[{"text": text, "n_chars": n_chars}.get(c, F.col(names[c]).alias(c)) for c in docs.columns])


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find_repeats(docs, DigestWindows()).drop("text")


SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
win AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, {2 * WIDTH})) AS h
  FROM (SELECT doc_id, x, unnest(range(0, n - {WIDTH - 1})) AS i FROM d)),
low AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WIDTH})) AS p FROM win JOIN low USING (h) WHERE doc_id > m),
spans AS (
  SELECT doc_id, count(*) AS n_spans
  FROM (SELECT doc_id, p - lag(p, 1, -2) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM cov) WHERE step > 1 GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(byte, '' ORDER BY p) AS t, count(*) AS k
  FROM (SELECT doc_id, p, substr(x, 2 * p + 1, 2) AS byte FROM (SELECT doc_id, x, unnest(range(0, n)) AS p FROM d))
  ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, n - coalesce(k, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""
