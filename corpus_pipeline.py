"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and is written as Parquet
and read again before the next.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import op01_decontamination as decontamination
from docweave.llm import op03_best_fit_packing as packing
from docweave.llm import op04_ngram_jaccard as jaccard
from docweave.llm import op06_suffix_array_dedup as substrings
from docweave.llm import op07_language_id as languages
from docweave.llm.common import bound_batches, read, staged

#: A text of at least so many characters goes if less than this share of its n-grams fits any language.
MIN_SCORE = 0.1
MIN_CHARS = 40


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null texts, too) and long ones in no learned language go.

    Languages are learned from all labelled rows (the held-out fold is op7's alone), also from a single one.
    Where none could be learned (no labelled row) every text with a letter stays, and so does one whose own
    label was not learned."""
    bound_batches(spark)
    lettered = docs.where(languages.has_letter("text"))
    filters = languages.fit_filters(docs, singles=True)
    if not filters.langs:
        return lettered
    unlearned = F.coalesce(~F.col("lang").isin(filters.langs), F.lit(False))
    strange = (F.col("score") < MIN_SCORE) & (F.length("text") >= MIN_CHARS) & ~unlearned
    return languages.identify_languages(lettered, filters).where(~strange).select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays."""
    return jaccard.keep_one_of_each(docs)


def distinct_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller doc_id has, too, are cut from the texts."""
    return substrings.remove_repeated_substrings(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row for each piece of a document with its place."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", distinct_documents),
    ("suffix_array_dedup", distinct_substrings),
    ("decontamination", uncontaminated),
    ("best_fit_packing", packed),
]

#: Tokenizing and learned languages are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
