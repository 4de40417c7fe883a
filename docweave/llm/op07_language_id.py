"""Language ID: bit-sliced Bloom filters over byte n-grams return, for each n-gram, the bitmask of all
languages that contain it; per-language popcounts, corrected for false positives, decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, free_names, mix, read

UNDETERMINED = "und"
GRAM = 4  # bytes, so that an n-gram is exactly one 32-bit number

#: Bounds of the fit: labelled documents, and n-grams kept, per language.
MAX_DOCS_PER_LANG = 3_000
MAX_GRAMS_PER_LANG = 30_000
#: The ids' hashes are counted in so many ranges (as a power of two) of each language.
RANGE_BITS = 12
MASK = 64  # languages of a mask word
HASHES = 3

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[:0x80] = 0x20  # what is no letter separates words
_LOWERED[0x41:0x5B] = np.arange(0x61, 0x7B, dtype=np.uint8)
_LOWERED[0x61:0x7B] = np.arange(0x61, 0x7B, dtype=np.uint8)


def grams_of(text: str) -> np.ndarray:
    """The overlapping 4-byte n-grams of the letters' bytes (other ASCII as spaces), without those that
    are mostly space."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    b = _LOWERED[np.frombuffer(b"  " + raw + b"  ", np.uint8)]
    space = b == 0x20
    if len(b) > 2:  # one space for a run of them
        keep = np.ones(len(b), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        b = b[keep]
    b = np.concatenate([b, np.full(max(0, GRAM - len(b)), 0x20, np.uint8)]).astype(np.uint32)
    n = len(b) - GRAM + 1
    return b[:n] | b[1 : n + 1] << 8 | b[2 : n + 2] << 16 | b[3 : n + 3] << 24


class LanguageFilters:
    """One Bloom filter per language, stored sliced: row r holds bit r of every language's filter, in one word
    for each 64 languages."""

    def __init__(self, grams: dict[str, np.ndarray], prior: str):
        self.langs = sorted(grams)
        self.prior = prior
        most = max([len(g) for g in grams.values()] or [1])
        self.bits = max(12, int(most * 16 - 1).bit_length())
        self.rows = np.zeros((1 << self.bits, max(1, -(-len(self.langs) // MASK))), np.uint64)
        for k, lang in enumerate(self.langs):
            for at in self._places(grams[lang]):
                self.rows[at, k // MASK] |= np.uint64(1 << k % MASK)
        fill = [float(((self.rows[:, k // MASK] >> np.uint64(k % MASK)) & np.uint64(1)).mean()) for k in range(len(self.langs))]
        self.false_rate = np.array(fill) ** HASHES

    def _places(self, grams: np.ndarray) -> list[np.ndarray]:
        h = mix(grams.astype(np.uint64))
        mask = np.uint64((1 << self.bits) - 1)
        return [(h >> np.uint64(21 * k)) & mask if 21 * k + self.bits <= 64 else mix(h, k) & mask for k in range(HASHES)]

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram the languages whose filter has it, in mask words."""
        out = None
        for at in self._places(grams):
            got = self.rows[at]
            out = got if out is None else out & got
        return out

    def shares(self, text: str) -> np.ndarray:
        """Per language, the share of the text's n-grams in its filter, corrected for false positives."""
        found = []
        for word in self.masks(grams_of(text)).T:
            masks, counts = np.unique(word, return_counts=True)
            has = (masks[:, None] >> np.arange(MASK, dtype=np.uint64)) & np.uint64(1)
            found.append((has * counts[:, None].astype(np.uint64)).sum(0) / counts.sum())
        found = np.concatenate(found)[: len(self.langs)]
        return np.clip((found - self.false_rate) / (1 - self.false_rate), 0.0, 1.0)

    def decide(self, text: str | None, has_letter: bool) -> tuple[str, float]:
        if text is None or not has_letter or not self.langs:
            return UNDETERMINED, 0.0
        shares = self.shares(text)
        best = int(np.argmax(shares))  # of equal ones the first by name
        if shares[best] <= 0:
            return self.prior, 0.0
        return self.langs[best], float(shares[best])


def fit_filters(labelled: DataFrame, docs_per_lang: int = MAX_DOCS_PER_LANG, grams_per_lang: int = MAX_GRAMS_PER_LANG, singles: bool = False) -> LanguageFilters:
    """Fits on (doc_id, text, lang) rows: at most ``docs_per_lang`` documents of each language (smallest
    id hashes), their n-grams counted in Spark.  A language's filter gets its ``grams_per_lang`` most
    frequent n-grams whose relative frequency is at least a quarter of the highest in any language, so
    shared n-grams are in several filters.  The language with most labelled rows is the prior.  An n-gram seen once teaches nothing, unless with ``singles`` its
    language has no other.  Rows without text, lang or id teach nothing."""
    rows = labelled.select("doc_id", "lang", "text").dropna()
    # the smallest hashes of each language: ranges of hashes are counted, and only the ids up to the range in which
    # the bound is reached are ranked, so no task gets a language's rows
    hashed = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("_h")).withColumn("_range", F.shiftright("_h", 64 - RANGE_BITS))
    counted = checkpointed(hashed.groupBy("lang", "_range").agg(F.count("*").alias("_n")))
    reached = F.sum("_n").over(W.partitionBy("lang").orderBy("_range")) - F.col("_n")
    enough = counted.withColumn("_before", reached).where(F.col("_before") < docs_per_lang)
    last = enough.groupBy("lang").agg(F.max("_range").alias("_last"))
    first = W.partitionBy("lang").orderBy("_h", "doc_id")
    near = hashed.join(F.broadcast(last), "lang").where("_range <= _last")
    picked = near.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= docs_per_lang)
    ids = picked.select("doc_id", "lang").distinct()  # at most docs_per_lang narrow keys a language
    sample = rows.join(broadcast_if_small(ids, ids.count()), ["doc_id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                gram, n = np.unique(np.concatenate([grams_of(t) for t in own]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram)), "gram": gram.astype(np.int64), "n": n})

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_lang, by_gram = W.partitionBy("lang"), W.partitionBy("gram")
    share = F.col("n") / F.sum("n").over(by_lang)
    if singles:
        counts = counts.withColumn("least", F.least(F.lit(2), F.max("n").over(by_lang)))
    else:
        counts = counts.withColumn("least", F.lit(2))
    kept = (
        counts.withColumn("share", share)
        .withColumn("top", F.max("share").over(by_gram))
        .where("n >= least and share >= 0.25 * top")
        .withColumn("k", F.row_number().over(by_lang.orderBy(F.desc("n"), "gram")))
        .where(F.col("k") <= grams_per_lang)
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"))
    )
    grams = {r["lang"]: np.array(r["grams"], np.int64).astype(np.uint32) for r in kept.toLocalIterator()}
    sizes = counted.groupBy("lang").agg(F.sum("_n").alias("count")).orderBy(F.desc("count"), "lang").first()
    return LanguageFilters(grams, sizes["lang"] if sizes else UNDETERMINED)


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify_languages(docs: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: the corrected share of the whole text's n-grams
    that the language's filter has).

    Null texts and texts without a letter get ``und`` and 0; a text whose n-grams no filter has gets the
    most frequent language and 0; equal shares go to the first language by name.  Rows that repeat are judged alike,
    whole texts of any length, and an empty table gives no rows; columns of the two names are replaced.  Nothing is shuffled:
    the filters (2^19 rows of 8 bytes for each 64 languages at the default bounds) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def decide(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        f = shared.value
        for texts, letters in parts:
            got = [f.decide(t, bool(x)) for t, x in zip(texts, letters, strict=True)]
            yield pd.DataFrame(got, columns=["lang_pred", "score"])

    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    (judged,) = free_names(docs.columns, "_judged")
    return docs.withColumn(judged, decide(F.col(text), has_letter(text))).select(*keep, f"{judged}.lang_pred", f"{judged}.score")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def learn(docs: DataFrame) -> LanguageFilters:
    """Fits on the documents outside the held-out fold; a null doc_id is in no fold and teaches nothing."""
    return fit_filters(docs.where(~held_out(F.col("doc_id"), 3, 1)))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = identify_languages(docs.select("doc_id", "text"), learn(docs))
    return judged.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")
