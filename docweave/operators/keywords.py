"""F4 keyword extraction and A6 word frequency.

Words are lower-cased runs of at least three ASCII letters standing between Unicode word boundaries
(so ``éabc`` yields nothing), minus the stop words.  Keywords are the ``max_keywords`` most frequent
words of a document, ties broken by first occurrence.

A document is one row, so its words are counted where the row is read: an Arrow flat-map, no shuffle, and
rows that share a key are never mixed up.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import bound_batches, bound_bytes
from .batches import flat_map_text

_TOKEN_GAP = re.compile(r"\W+")
_WORD = re.compile(r"[a-z]{3,}")
_STOP = frozenset(S.STOP_WORDS)


def count_words(text: str | None) -> dict[str, list[int]]:
    """word -> [frequency, position of its first token], in the order of first occurrence."""
    found: dict[str, list[int]] = {}
    for at, token in enumerate(_TOKEN_GAP.split((text or "").lower())):
        if token in found:
            found[token][0] += 1
        elif token not in _STOP and _WORD.fullmatch(token):
            found[token] = [1, at]
    return found


def top_words(text: str | None, n: int) -> list[tuple[str, int]]:
    ranked = sorted(count_words(text).items(), key=lambda x: (-x[1][0], x[1][1]))
    return [(word, freq) for word, (freq, _) in ranked[:n]]


def _fields(last: str) -> list[T.StructField]:
    return [T.StructField("word", T.StringType()), T.StructField("freq", T.LongType()), T.StructField(last, T.IntegerType())]


def word_frequency(df: DataFrame, text_col: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keys, word, freq, first_pos) per distinct keyword candidate of each document."""
    return flat_map_text(df, text_col, list(keys), _fields("first_pos"), lambda t: ((w, n, at) for w, (n, at) in count_words(t).items()))


def keyword_ranks(
    df: DataFrame, text_col: str = "text", keys: Sequence[str] = ("doc_id",), max_keywords: int = 10
) -> DataFrame:
    """(keys, rank, word, freq): the top ``max_keywords`` words of each document, long form."""
    return flat_map_text(
        df, text_col, list(keys), _fields("rank"), lambda t: [(w, n, k + 1) for k, (w, n) in enumerate(top_words(t, max_keywords))]
    )


def extract_keywords(
    df: DataFrame, text_col: str = "text", keys: Sequence[str] = ("doc_id",), max_keywords: int = 10
) -> DataFrame:
    """one row per document row: keys + ``keywords`` (array, best first; empty when none)."""
    bound_batches(df.sparkSession)
    bound_bytes(df.sparkSession)

    @F.pandas_udf("array<string>")
    def keywords(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [w for w, _ in top_words(t, max_keywords)])

    return df.select(*keys, keywords(F.col(text_col)).alias("keywords"))
