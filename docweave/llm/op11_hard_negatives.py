"""Hard-negative mining: LEMP-style search of each anchor's best positives and of the best negatives that stay
below them.

Rows lie in buckets of similar length.  A bucket holds, for each coordinate, the list of its rows' direction
values in order.  An anchor that needs a score of t needs a cosine of at least t / (its length x the bucket's
longest row); a cosine bounds every single coordinate, so each of the anchor's strongest coordinates (its focus)
gives a feasible range of its list.  Rows in all the ranges are verified with the exact inner product, and what
they score raises t for the buckets after."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, read, staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative scores at least LOW and at most HIGH per cent of the positive.
LOW, HIGH = 50, 95

#: Quantiles of the rows' lengths that bound the length classes; a class is dealt by hash into blocks, each for a
#: task of its own, of LEAST_BLOCK to MOST_BLOCK rows.  Rows of a bucket in a block, anchors that meet a block at
#: once, and coordinates of an anchor's focus.  LOOK rows of a bucket's list are looked at for the SEEDS of a threshold.
CLASSES = 16
LEAST_BLOCK, MOST_BLOCK = 2048, 8192
BUCKET = 1024
MOST_ANCHORS = 4096
FOCUS = 6
LOOK, SEEDS = 512, 32
SLACK = 1e-9
MAX_LONG = (1 << 63) - 1


class Bucket:
    """Rows of similar length: their coordinate lists, made when first asked for."""

    def __init__(self, at: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.at, self.longest = at, float(lengths.max())
        self.directions = vectors / np.maximum(lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def ordered(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, values) of a coordinate's list."""
        if f not in self.lists:
            order = np.argsort(self.directions[:, f], kind="stable")
            self.lists[f] = order, self.directions[order, f]
        return self.lists[f]

    def nearest(self, focus: list[tuple[int, float]]) -> np.ndarray:
        """Some rows to find a first threshold with: of those whose strongest focus coordinate is near the
        anchor's, the ones that agree best in the whole focus."""
        (f, value), *_ = focus
        order, values = self.ordered(f)
        middle = int(np.searchsorted(values, value))
        near = order[max(0, middle - LOOK // 2) : middle + LOOK // 2]
        if len(near) > SEEDS:
            own, by = zip(*focus, strict=True)
            alike = self.directions[near[:, None], np.array(own)] @ np.array(by)
            near = near[np.argpartition(-alike, SEEDS)[:SEEDS]]
        return self.at[near]

    def candidates(self, focus: list[tuple[int, float]], cosine: float) -> np.ndarray:
        """Rows inside the feasible ranges of all focus coordinates."""
        angle = math.acos(min(1.0, cosine))
        ranges = []
        for f, value in focus:
            own = math.acos(max(-1.0, min(1.0, value)))
            low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            values = self.ordered(f)[1]
            begin, end = int(np.searchsorted(values, low, "left")), int(np.searchsorted(values, high, "right"))
            if begin >= end:
                return self.at[:0]
            ranges.append((end - begin, f, begin, end, low, high))
        if not ranges:
            return self.at
        ranges.sort()
        _, f, begin, end, _, _ = ranges[0]
        found = self.ordered(f)[0][begin:end]
        for _, f, _, _, low, high in ranges[1:]:  # the same as intersecting the ranges' rows
            x = self.directions[found, f]
            found = found[(x >= low) & (x <= high)]
        return self.at[found]


class Index:
    """A block's vectors in buckets by falling length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        lengths = np.sqrt((vectors * vectors).sum(1))
        order = np.argsort(-lengths, kind="stable")
        parts = [order[k : k + BUCKET] for k in range(0, len(order), BUCKET)]
        self.buckets = [Bucket(part, vectors[part], lengths[part]) for part in parts]
        self.most = float(np.abs(vectors).max(initial=0.0))
        self.verified = 0

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products as longs (beyond a long: its largest or smallest)."""
        if self.most * float(np.abs(anchor).max(initial=0.0)) * max(1, len(anchor)) < 2.0**53:
            return (self.vectors[rows] @ anchor).astype(np.int64)
        own = [int(x) for x in anchor]
        exact = (sum(int(x) * y for x, y in zip(v, own, strict=True)) for v in self.vectors[rows])
        return np.array([max(-MAX_LONG, min(MAX_LONG, x)) for x in exact], np.int64)

    def search(self, anchor_id: int, anchor: np.ndarray, k: int, spans: list[tuple[int, int]], without_label: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each span (low, high) the rows of the k best scores in it, best first, ties by smaller id: (ids,
        scores).  The anchor's own row, and rows of ``without_label``, are no candidates."""
        length = math.sqrt(float((anchor * anchor).sum()))
        focus = []
        if length > 0:
            strongest = np.argsort(-np.abs(anchor), kind="stable")[:FOCUS]
            focus = [(int(f), float(anchor[f]) / length) for f in strongest]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in spans]
        needed = [low for low, _ in spans]

        def verify(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keep = self.ids[rows] != anchor_id
            if without_label is not None:
                keep &= self.labels[rows] != without_label
            rows = rows[keep]
            self.verified += len(rows)
            return rows, self.scores(anchor, rows)

        if focus and self.buckets:  # a first threshold, from a few rows of every bucket
            _, scores = verify(np.concatenate([bucket.nearest(focus) for bucket in self.buckets]))
            for j, (_, high) in enumerate(spans):
                fit = scores[scores <= high]
                if len(fit) >= k:
                    needed[j] = max(needed[j], int(np.partition(fit, len(fit) - k)[len(fit) - k]))
        for bucket in self.buckets:
            least = min(needed)
            rows = bucket.at
            if least > 0:
                reach = length * bucket.longest
                if least > reach * (1 + SLACK) + SLACK:
                    break  # this bucket's rows are too short, and so are those of all after it
                rows = bucket.candidates(focus, least / reach * (1 - SLACK) - SLACK)
            rows, scores = verify(rows)
            for j, (low, high) in enumerate(spans):
                fit = (scores >= max(low, needed[j])) & (scores <= high)
                ids = np.concatenate([found[j][0], self.ids[rows[fit]]])
                own = np.concatenate([found[j][1], scores[fit]])
                best = np.lexsort((ids, -own))[:k]
                found[j] = ids[best], own[best]
                if len(best) == k:
                    needed[j] = max(needed[j], int(own[best[-1]]))
        return found


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * flat.reshape(rows, -1)), -(2.0**62), 2.0**62)


POSITIVE = ["anchor_id", "positive_id", "positive_score"]
NEGATIVE = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]


def _best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return _table([], POSITIVE)
    ids, labels = left["vec_id"].to_numpy(), left["label"].to_numpy()
    vectors = _matrix(left["embedding"], len(ids))
    indexes: dict[int, Index] = {}
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    anchors = _matrix(right["embedding"], right.num_rows)
    everything = [(-MAX_LONG - 1, MAX_LONG)]
    for anchor_id, label, anchor in zip(right["vec_id"].to_pylist(), right["label"].to_pylist(), anchors, strict=True):
        if label not in indexes:
            own = np.flatnonzero(labels == label)
            indexes[label] = Index(ids[own], labels[own], vectors[own])
        ((found, scores),) = indexes[label].search(anchor_id, anchor, POSITIVES, everything)
        out.append((np.full(len(found), anchor_id), found, scores))
    return _table(out, POSITIVE)


def _best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return _table([], NEGATIVE)
    ids = left["vec_id"].to_numpy()
    index = Index(ids, left["label"].to_numpy(), _matrix(left["embedding"], len(ids)))
    out: list[tuple[np.ndarray, ...]] = []
    anchors = _matrix(right["embedding"], right.num_rows)
    for anchor_id, label, positives, anchor in zip(right["vec_id"].to_pylist(), right["label"].to_pylist(), right["positives"].to_pylist(), anchors, strict=True):
        spans = [(-(-LOW * p["positive_score"] // 100), HIGH * p["positive_score"] // 100) for p in positives]
        for p, (found, scores) in zip(positives, index.search(anchor_id, anchor, NEGATIVES, spans, label), strict=True):
            n = len(found)
            out.append((np.full(n, anchor_id), np.full(n, p["positive_id"]), found, np.full(n, p["positive_score"]), scores))
    return _table(out, NEGATIVE)


def _table(rows: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*rows, strict=True)] or [np.zeros(0)] * len(names)
    return pa.table({name: c.astype(np.int64) for name, c in zip(names, columns, strict=True)})


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part; of rows that share a vec_id the first by label and
    vector.  Only repeated ids, found on the ids alone, cost a shuffle of vectors."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    element = "float" if kind == "float" else "double"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast(f"array<{element}>").alias("embedding"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    repeated = checkpointed(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"))
    n = repeated.count()
    if not n:
        return rows
    repeated = broadcast_if_small(repeated, n)
    first = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r"))
    return rows.join(repeated, "vec_id", "left_anti").unionByName(first.select("vec_id", "r.label", "r.embedding"))


def relabelled(label: Column, vec_id: Column) -> Column:
    """Each seventh id counts as the label after its own."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``dims`` and ``block``: length classes between quantiles, each dealt by hash into blocks of a
    bounded size, so neither equal lengths nor a frequent vector make a large one."""
    squares = F.transform("embedding", lambda x: F.pow(F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"), F.lit(2.0)))
    rows = rows.withColumn("dims", F.size("embedding")).withColumn("length", F.aggregate(squares, F.lit(0.0), lambda a, b: a + b))
    steps = [k / CLASSES for k in range(1, CLASSES)]
    cuts = checkpointed(rows.groupBy("dims").agg(F.percentile_approx("length", steps, 1000).alias("cuts"), F.count("*").alias("all")))
    rows = rows.join(broadcast_if_small(cuts, cuts.count()), "dims")
    rows = rows.withColumn("class", F.size(F.filter("cuts", lambda c: c < F.col("length"))))
    sizes = checkpointed(rows.groupBy("dims", "class").agg(F.count("*").alias("held"), F.first("all").alias("total")))
    target = F.least(F.greatest(F.col("total") / 64, F.lit(LEAST_BLOCK)), F.lit(MOST_BLOCK))
    sizes = sizes.select("dims", "class", F.ceil(F.col("held") / target).cast("int").alias("parts"))
    dealt = rows.join(broadcast_if_small(sizes, sizes.count()), ["dims", "class"])
    block = F.concat_ws(":", "class", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    return dealt.select("vec_id", "label", "embedding", "dims", block.alias("block"))


def _meet(rows: DataFrame, anchors: DataFrame, count: int, found, schema: str) -> DataFrame:
    """Every block of rows with every block of anchors of the same dimensions, as groups of bounded size: rows are
    sent once for each block of anchors, anchors once for each block of rows."""
    parts = max(1, -(-count // MOST_ANCHORS))
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")).withColumn("dims", F.size("embedding"))
    names = rows.select("dims", "block").distinct()
    right = anchors.join(names, "dims")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of their own beside those of the rows
    left = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    key = ["dims", "block", "part"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(found, schema)


def mine_hard_negatives(vectors: DataFrame, anchor: Column, label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row of (vec_id,
    label, embedding) that fits ``anchor`` (a condition on vec_id), its POSITIVES best other rows of the same
    label, and for each of them the NEGATIVES best rows of another label that score LOW to HIGH per cent of it.

    A component x counts as floor(256 * x) in double precision, a score is the inner product of those integers,
    exact at any size (beyond a long: the largest or smallest one; beyond 2^62 a component counts as 2^62).
    Higher scores come first, ties by smaller id.  ``label`` may replace the column of that name.  Rows with a null
    id, label or vector, or with a null or non-finite component, take no part.  Of rows that share a vec_id the
    first by label and vector counts, so repeated rows count once.  Only vectors of equal length are compared; empty ones score 0.
    An anchor without positives, and a positive without negatives in its range, gives no rows, as does an empty
    table.  Other columns are ignored.

    All anchors are searched against all rows, block by block, so the work grows with their product; what the
    buckets' lists rule out is not scored.  A task holds one block of rows and one of anchors."""
    usable = _usable(vectors)
    if label is not None:
        usable = usable.withColumn("label", label)
    rows, anchors = staged(_blocks(usable)), usable.where(anchor)
    count = anchors.count()
    positives = _meet(rows, anchors, count, _best_positives, ", ".join(f"{c} long" for c in POSITIVE))
    best = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = positives.withColumn("n", F.row_number().over(best)).where(F.col("n") <= POSITIVES)
    # at most POSITIVES structs an anchor; below zero no negative fits
    wanted = positives.where("positive_score >= 0").groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = anchors.join(wanted, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    negatives = _meet(rows, asking, count, _best_negatives, ", ".join(f"{c} long" for c in NEGATIVE))
    hardest = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return negatives.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, relabelled(F.col("label"), F.col("vec_id")))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) = 1),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS alike, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
p AS (SELECT a, b, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (
  SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
