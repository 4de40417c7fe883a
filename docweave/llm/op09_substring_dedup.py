"""Substring dedup by recompression: rounds of run and pair naming give equal word sequences equal interior
symbols; windows of 50 words that share their highest symbol are compared whole.

No Spark round names anything: each task runs all four rounds (symbols of at most 8 words) over its own text, to
choose a minimizer-like anchor for each window; Spark only brings equal anchors together (``repeats.py``).

A name is a hash of the names it replaces, so it is the same wherever the same words were merged, in any
task, without a table of names.  Whether two neighbours merge depends on their names and spans alone:
a run of one name merges when it spans at most the round's cap, a pair merges when the first is "left",
the second "right" by a bit of their names and both together are within the cap."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import WordHash, mix, odd_factors, read
from .repeats import RangeNames, find_repeats, ranges, sliding_min, window_mask, window_runs

WIDTH = 50
#: (kind, most words of a merged symbol).  What surrounds a sequence can change, at each of its ends, the
#: symbols of at most cap words in a run round and cap - 1 in a pair round.
ROUNDS = (("run", 4), ("pair", 2), ("pair", 4), ("pair", 8))
MARGIN = sum(cap if kind == "run" else cap - 1 for kind, cap in ROUNDS)
assert WIDTH - 2 * MARGIN >= 1

_F, _G = (np.uint64(x) for x in odd_factors(2))


def recompress(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, span) of the symbols that the rounds leave; nothing merges across documents."""
    name, span = words.copy(), np.ones(len(words), np.int64)
    for k, (kind, cap) in enumerate(ROUNDS):
        if len(name) < 2:
            break
        if kind == "run":
            fresh = np.ones(len(name), bool)
            fresh[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(fresh)
            length = np.diff([*first, len(name)])
            merge = (length > 1) & (length * span[first] <= cap)
            gone = np.repeat(merge, length) & ~fresh
            named = mix(name[first] * _F + length.astype(np.uint64), k + 1)
            total = length * span[first]
            name[first[merge]], span[first[merge]] = named[merge], total[merge]
        else:
            right = (mix(name, 100 + k) >> np.uint64(63)).astype(bool)
            at = np.flatnonzero(~right[:-1] & right[1:] & (doc[1:] == doc[:-1]) & (span[1:] + span[:-1] <= cap))
            gone = np.zeros(len(name), bool)
            gone[at + 1] = True
            name[at] = mix(name[at] * _F + name[at + 1] * _G, k + 1)
            span[at] += span[at + 1]
        name, span, doc = name[~gone], span[~gone], doc[~gone]
    return name, span


class WordWindows:
    """Windows of 50 words, anchored at the widest symbol over the words that no surrounding can touch."""

    width = WIDTH
    results = {"n_words": "long", "n_removed": "long", "kept": "string"}
    _hash = WordHash()

    def load(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = [t.split() for t in texts]
        return self._hash.array([w for own in words for w in own]), np.cumsum([0, *map(len, words)])

    def segments(self, hashed: np.ndarray, bounds: np.ndarray, use: np.ndarray) -> Iterator[tuple]:
        if len(hashed) < WIDTH:
            return
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        name, span = recompress(hashed, doc)
        # widest first, then by name
        value = ((np.uint64(15) - span.astype(np.uint64)) << np.uint64(60)) | (mix(name) >> np.uint64(4))
        least = sliding_min(np.repeat(value, span), WIDTH - 2 * MARGIN)[MARGIN:]
        valid = window_mask(bounds, use, WIDTH)[: len(least)]
        least = least[: len(valid)]
        start, count = window_runs(least, valid)
        yield least[start], start, count

    def values(self, hashed: np.ndarray) -> np.ndarray:
        return hashed

    def prepare(self, hashed: np.ndarray) -> np.ndarray:
        """Names of all windows."""
        return RangeNames(hashed).of(np.arange(max(0, len(hashed) - WIDTH + 1)), WIDTH)

    def payload(self, names: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
        return names[ranges(start, count)].astype("<u8").tobytes()

    def unload(self, data: bytes, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(data, "<u8"), count

    def names(self, load: np.ndarray, size: np.ndarray, count: np.ndarray) -> np.ndarray:
        return load

    def result(self, text: bytes, _, a: int, b: int, cover: np.ndarray) -> tuple:
        words = text.split()
        kept = b" ".join(words if not cover.any() else [w for w, c in zip(words, cover.tolist(), strict=True) if not c])
        return int(b - a), int(cover.sum()), kept.decode(errors="replace")


class DigestWordWindows(WordWindows):
    results = {"n_words": "long", "n_removed": "long", "kept_sha256": "string"}

    def result(self, *args) -> tuple:
        *numbers, kept = super().result(*args)
        return *numbers, hashlib.sha256(kept.encode()).hexdigest()


def remove_repeated_words(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and ``kept``: the words left, joined by one space.  A null text has no
    words; all rows stay; existing columns of these names are replaced."""
    return find_repeats(docs, WordWindows())


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find_repeats(docs, DigestWordWindows()).drop("text")


SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i + 1, i + {WIDTH}), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - {WIDTH - 1})) AS i FROM d)),
low AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WIDTH})) AS p FROM win JOIN low USING (h) WHERE doc_id > m),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d) ANTI JOIN cov USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
