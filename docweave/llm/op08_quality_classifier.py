"""Quality classifier: nearest-neighbour voting over broadcast latent-semantic vectors of labelled texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, read
from .op07_language_id import held_out

#: Bounds of the fit: labelled rows, hashed terms, latent dimensions, neighbours that vote.
MAX_TRAIN_ROWS = 4_000
TERMS = 1_024
STYLE_BINS = 16
DIMENSIONS = 64
NEIGHBOURS = 25
PREDICT_AT = 0.3

_KIND = np.full(256, 3, np.uint8)  # 0 space, 1 lower case and other letters, 2 upper case, 3 digit, 4 mark
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[0x21:0x80] = 4
_KIND[0x30:0x3A] = 3
_KIND[0x41:0x5B] = 2
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 1


def _bins(values: list[float]) -> list[tuple[int, float]]:
    """Each value from 0 to 1 as two neighbouring soft bins, so close values share terms."""
    out = []
    for k, v in enumerate(values):
        x = min(max(v, 0.0), 1.0) * (STYLE_BINS - 1)
        low = int(x)
        out.append((k * STYLE_BINS + low, 1 - (x - low)))
        if x > low:
            out.append((k * STYLE_BINS + low + 1, x - low))
    return out


N_STYLES = 9
WIDTH = TERMS + N_STYLES * STYLE_BINS


def terms_of(text: str | None) -> np.ndarray:
    """The raw term vector of a whole text: hashed byte 3-grams (log counts, unit length) and soft bins of
    how it is written: length, repeated words, repeated neighbours, repeated lines, capitals, digits,
    marks, words without vowels' share of plain letters, and word length."""
    out = np.zeros(WIDTH, np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    low = raw.lower()
    b = np.frombuffer(low, np.uint8).astype(np.uint64)
    if len(b) >= 3:
        gram = mix(b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16)) & np.uint64(TERMS - 1)
        counts = np.log1p(np.bincount(gram.astype(np.int64), minlength=TERMS))
        out[:TERMS] = counts / np.linalg.norm(counts)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=5) / len(raw)
    words = low.split()
    n = max(1, len(words))
    lines = [x for x in low.split(b"\n") if x]
    styles = [
        np.log1p(len(words)) / 12,
        len(set(words)) / n,
        sum(a == c for a, c in zip(words, words[1:], strict=False)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        kinds[2] * 2,
        kinds[3] * 3,
        kinds[4] * 3,
        kinds[1],
        sum(map(len, words)) / n / 16,
    ]
    for at, weight in _bins([float(x) for x in styles]):
        out[TERMS + at] = weight
    return out


class NeighbourVote:
    """Labelled latent-semantic unit vectors; a text's score is the similarity-weighted mean label of its
    nearest ones."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS):
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        seen = (terms > 0).sum(0)
        idf = np.log((1 + len(terms)) / (1 + seen)) + 0.2
        idf[TERMS:] = 1.0
        gram = (terms * idf).T @ (terms * idf)
        values, axes = np.linalg.eigh(gram.astype(np.float64))
        top = np.argsort(-values, kind="stable")[:dimensions]
        self.project = (idf[:, None] * axes[:, top]).astype(np.float32)
        self.vectors = self._unit(terms @ self.project)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, terms: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Exact cosines of a block of texts with every labelled vector, then the vote of the k nearest."""
        if not len(self.labels):
            return np.full(len(terms), self.prior)
        own = self._unit(terms @ self.project)
        cosine = own @ self.vectors.T
        k = min(k, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0.0) ** 8
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1)
        return np.where(total > 1e-9, vote / np.maximum(total, 1e-9), self.prior).astype(np.float64).clip(0.0, 1.0)


def fit_vote(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> NeighbourVote:
    """Fits on the texts of the ``max_rows`` labelled ids with the smallest id hashes.  Their term vectors
    (about 4.7 kB each, so 19 MB at the default bound) are made in Spark and fitted on the driver.  Rows
    without id or quality teach nothing; a null text is the empty text; a label without a document is
    passed over."""
    known = labels.select("doc_id", "quality").dropna().distinct()
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [terms_of(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "quality": batch["quality"].cast(pa.int32()), "terms": pa.array(rows, pa.binary())})

    # several document rows may carry one id: the bound holds for them, too
    rows = sample.mapInArrow(features, "doc_id long, quality int, terms binary").orderBy("doc_id", "quality", "terms").limit(max_rows).collect()
    terms = np.frombuffer(b"".join(bytes(r["terms"]) for r in rows), np.float32).reshape(-1, WIDTH)
    return NeighbourVote(terms, np.array([r["quality"] for r in rows], np.float64))


def score_quality(docs: DataFrame, vote: NeighbourVote, text: str = "text", block: int = 256) -> DataFrame:
    """``docs`` with ``score``, the probability-like vote for label 1 (0 to 1).  Every whole text is scored,
    in blocks of ``block`` cosine rows; null and empty texts share the empty term vector and get the
    share of label 1; without labels every score is 0.5.  An existing ``score`` column is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(vote)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = shared.value
        for texts in parts:
            own = texts.tolist()
            got = [v.scores(np.stack([terms_of(t) for t in own[i : i + block]])) for i in range(0, len(own), block)]
            yield pd.Series(np.concatenate(got) if got else np.zeros(0))

    return docs.withColumn("score", score(F.col(text)))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    out = held_out(F.col("doc_id"), 5, 0)
    vote = fit_vote(docs, labels.where(~out))
    return score_quality(docs, vote).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted")
    )
