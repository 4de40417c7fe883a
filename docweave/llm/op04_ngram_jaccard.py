"""N-gram Jaccard join by multiple-global-order filtering: two word-shingle sets can reach the similarity
only if they share a token in their prefixes under every one of several global token orders.

The first order's prefixes are joined; the candidates must also share prefix tokens under the other
orders; what passes all filters is verified on whole sets.  Before that, parities and, of long sets, counts
of their tokens' hash buckets tell most unrelated pairs apart.  All orders put rare shingles first (by a
bounded table of document frequencies over the whole corpus) and differ in how they order the rest, so
a passage that many documents share comes last in all of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, connected_components, free_names, mix, odd_factors, read, SQL_LOWER, staged, WordHash

WORDS = 5
PERCENT = 80
ORDERS = 3
#: Frequency table: documents are counted in this many hash buckets, whatever the corpus holds.
BUCKETS = 1 << 22
SLICES = 64
#: Sets of a token from which on its rows carry sketches into the join of its open components.
MANY_SETS = 64
#: 64-bit words of a set's parity sketch, see ``sketch``.
SKETCH = 16
TEXTS_AT_ONCE = 256

_HASH = WordHash()
_FACTORS = odd_factors(64)


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text as 64-bit names; fewer words than a shingle has are one
    shingle, no words are none."""
    split = [(t or b"").lower().split() for t in texts]
    flat = _HASH.array([w for own in split for w in own])
    out, at = [], 0
    for own in split:
        h = flat[at : at + len(own)]
        at += len(own)
        n = len(h) - words + 1
        if n >= 1:
            name = np.zeros(n, np.uint64)
            for k in range(words):
                name += mix(h[k : k + n] * _FACTORS[k], k) if k else h[:n] * _FACTORS[0]
        else:
            name = np.full(min(len(h), 1), len(h), np.uint64)
            for x in h:
                name = mix(name * _FACTORS[words]) + x
        out.append(np.unique(mix(name)))
    return out


def _in_groups(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            yield part, shingle_sets(part["text"].cast(pa.binary()).to_pylist(), words)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(42)).astype(np.int64)


def _arrays(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, sets)])
    values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under a global order: rare classes first, then by the order's own hash.
    Sets with the required similarity share at least one of them."""
    n = len(tokens)
    keep = n - (percent * n + 99) // 100 + 1 if n else 0
    by = np.lexsort((mix(tokens, 50 + order), classes[_bucket(tokens)]))
    return tokens[by[:keep]]


COLUMNS = ["doc_id", "th", "n", "sig", "sketch", "counts", "slice"]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the tokens in each of 64 * SKETCH hash buckets, as bits.  Two sketches differ in at most as
    many bits as the sets' symmetric difference has tokens."""
    at = (mix(tokens, 90) % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = np.bincount(at, minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def long_from(percent: int) -> int:
    """The size from which on parities tell unrelated sets apart badly: two such sets may differ in 3/8 of a sketch's
    bits, and unrelated ones do in about half of them."""
    return 3 * 64 * SKETCH * (100 + percent) // (16 * max(1, 100 - percent))


def bucket_counts(tokens: np.ndarray) -> np.ndarray:
    """The number of tokens, up to 127, in each of the sketch's hash buckets.  The counts of two sets differ by as
    much, in sum, as the sets' symmetric difference has tokens at most."""
    at = (mix(tokens, 90) % np.uint64(64 * SKETCH)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=64 * SKETCH), 127).astype(np.int8)


def summarize(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, th, n, sig, sketch, counts) per row, and the frequency class of every bucket.

    One pass over the texts; ``sig`` is a 128-bit name of the whole set, null for an empty one; ``counts`` are those
    of ``bucket_counts`` for long sets, null for others."""
    least = long_from(percent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.uint32)  # of one task's documents
        for part, sets in _in_groups(batches, words):
            for tokens in sets:
                np.add.at(counts, _bucket(tokens), 1)
            sig = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].cast(pa.int64()), part["th"], pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary()), pa.array([sketch(s) for s in sets], pa.list_(pa.int64())), pa.array([bucket_counts(s) if len(s) >= least else None for s in sets], pa.list_(pa.int8())), pa.nulls(len(sets), pa.int32())],
                COLUMNS,
            )
        if counts.any():
            data = [zstandard.compress(c.astype(np.uint64).tobytes(), 1) for c in np.split(counts, SLICES)]
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(data, pa.binary()), pa.nulls(SLICES, pa.list_(pa.int64())), pa.nulls(SLICES, pa.list_(pa.int8())), pa.array(range(SLICES), pa.int32())], COLUMNS)

    both = checkpointed(
        docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(scan, "doc_id long, th long, n long, sig binary, sketch array<long>, counts array<tinyint>, slice int")
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch["slice"].to_pylist(), batch["data"].to_pylist(), strict=True):
                own = np.frombuffer(zstandard.decompress(data), np.uint64)
                sums[k] = sums[k] + own if k in sums else own
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(sums), pa.int32()), "data": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    sums = both.where("slice is not null").select("slice", F.col("sig").alias("data")).repartition(SLICES, "slice").mapInArrow(add, "slice int, data binary")
    classes = np.zeros(BUCKETS, np.uint8)
    for r in sums.toLocalIterator():  # at most 8 bytes a bucket
        size = BUCKETS // SLICES
        counts = np.frombuffer(bytes(r["data"]), np.uint64)
        # half powers of two: what differs by less is ordered by hash
        classes[r["slice"] * size : (r["slice"] + 1) * size] = np.ceil(2 * np.log2(counts + 1.0))
    return both.where("slice is null").drop("slice"), classes


def _size_fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _sketches_fit(x: str, y: str, percent: int) -> Column:
    """Whether sizes and sketches allow the similarity: similar enough sets differ in at most
    (100 - percent) / (100 + percent) of both sizes' sum."""
    size_x, size_y = F.col(f"{x}_n"), F.col(f"{y}_n")
    bits = [F.bit_count(F.col(f"{x}_sketch")[k].bitwiseXOR(F.col(f"{y}_sketch")[k])) for k in range(SKETCH)]
    differ = sum(bits[1:], bits[0])
    return _size_fits(size_x, size_y, percent) & (differ * (100 + percent) <= (size_x + size_y) * (100 - percent))


def _counts_fit(x: str, y: str, percent: int) -> Column:
    """Whether two long sets' bucket counts allow the similarity, as in ``_sketches_fit``; true of other sets."""
    each = F.zip_with(f"{x}_counts", f"{y}_counts", lambda a, b: F.abs(a.cast("int") - b.cast("int")))
    differ = F.aggregate(each, F.lit(0), lambda total, d: total + d)
    return F.coalesce(differ * (100 + percent) <= (F.col(f"{x}_n") + F.col(f"{y}_n")) * (100 - percent), F.lit(True))


def close_pairs(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sizes, sketches and bucket counts allow the similarity."""
    side = lambda c: reps.select(F.col("node").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("n", "sketch", "counts")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_sketches_fit("a", "b", percent)).where(_counts_fit("a", "b", percent)).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, classes, words: int, percent: int) -> DataFrame:
    """The (a, b) of candidate pairs that share prefix tokens under the other orders, too, and whose whole
    sets reach the similarity.  Only texts in some pair are read again."""
    nodes = checkpointed(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    some = docs.select("doc_id", "text").join(broadcast_if_small(nodes, nodes.count()), "doc_id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _in_groups(batches, words):
            cols = [part["doc_id"].cast(pa.int64())]
            cols += [_arrays([prefix(s, classes.value, k, percent) for s in own]) for k in range(1, ORDERS)]
            yield pa.RecordBatch.from_arrays([*cols, _arrays(own)], ["node", *names, "items"])

    names = [f"p{k}" for k in range(1, ORDERS)]
    schema = "node long, " + ", ".join(f"{x} array<long>" for x in names) + ", items array<long>"
    table = staged(some.mapInArrow(sets, schema))
    side = lambda c, cols: table.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])
    left = pairs.join(side("a", names), "a").join(side("b", names), "b")
    for x in names:
        left = left.where(F.arrays_overlap(f"{x}_a", f"{x}_b"))
    passed = checkpointed(left.select("a", "b").distinct())
    # whole sets of the remaining pairs alone
    nodes = checkpointed(passed.select(F.col("a").alias("node")).union(passed.select("b")).distinct())
    table = table.join(broadcast_if_small(nodes, nodes.count()), "node", "left_semi")
    whole = passed.join(side("a", ["items"]), "a").join(side("b", ["items"]), "b")
    common = F.size(F.array_intersect("items_a", "items_b"))
    linked = common * 100 >= (F.size("items_a") + F.size("items_b") - common) * percent
    return whole.where(linked).select("a", "b").distinct()


def find_links(docs: DataFrame, reps: DataFrame, classes: np.ndarray, words: int, percent: int) -> DataFrame:
    """Links (a, b) between class representatives, enough of them that every linked pair is connected.

    A prefix token first pairs each of its sets with its smallest one.  Then, where a token's sets are still
    in several components, the sets outside of its largest one are paired with every set of another
    component.  So a large group of near copies costs its size, and no linked pair is left between two
    components."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(classes)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _in_groups(batches, words):
            sig = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            tokens = _arrays([prefix(s, shared.value, 0, percent) for s in sets])
            yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), pa.array(sig, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), tokens], ["node", "sig", "n", "tokens"])

    wide = docs.select("doc_id", "text").mapInArrow(prefixes, "node long, sig binary, n int, tokens array<long>")
    # both columns, so that the rows of a large class do not meet in one task
    wide = wide.join(reps.select("node", "sig"), ["node", "sig"], "left_semi")
    by_token = W.partitionBy("token")
    entry = F.struct("node", "n")
    posting = (
        wide.select("node", "n", F.explode("tokens").alias("token"))
        .withColumn("sets", F.count("*").over(by_token))
        .withColumn("low", F.min(entry).over(by_token))
        .where("sets > 1")
        .select("token", "node", "n", "sets", "low")
    )
    posting = staged(posting)
    hubs = posting.where((F.col("low.node") < F.col("node")) & _size_fits(F.col("low.n"), F.col("n"), percent))
    pairs = checkpointed(hubs.select(F.col("low.node").alias("a"), F.col("node").alias("b")).distinct())
    links = checkpointed(verified(checkpointed(close_pairs(pairs, reps, percent)), docs, shared, words, percent))

    parts = connected_components(links, "a", "b")
    # a token's only pair has been tried
    placed = posting.where("sets > 2").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = checkpointed(placed.select("token", "sets", "node", "n", "component"))
    sizes = placed.groupBy("token", "component").agg(F.count("*").alias("k"))
    major = sizes.groupBy("token").agg(F.max(F.struct("k", "component"))["component"].alias("major"), F.count("*").alias("c")).where("c > 1")
    open_ = placed.join(major, "token")

    def across(rows: DataFrame, fits) -> DataFrame:
        named = lambda df, c: df.select(*[F.col(x).alias(f"{c}_{x}") for x in rows.columns])
        minor, every = named(rows.where("component <> major"), "x"), named(rows, "y")
        met = minor.join(every, (F.col("x_token") == F.col("y_token")) & (F.col("x_component") != F.col("y_component")) & fits)
        return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()

    # a frequent token's pairs are cut down by sketches in the join itself, other tokens' few pairs after it
    many = open_.where(F.col("sets") > MANY_SETS).join(reps.select("node", "sketch"), "node")
    few = across(open_.where(F.col("sets") <= MANY_SETS), _size_fits(F.col("x_n"), F.col("y_n"), percent))
    rest = across(many, _sketches_fit("x", "y", percent)).union(few.join(pairs, ["a", "b"], "left_anti")).distinct()
    rest = checkpointed(close_pairs(rest, reps, percent).join(pairs, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        links = links.unionByName(checkpointed(verified(rest, docs, shared, words, percent)))
    return links


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) for every row of ``docs`` (doc_id, text): A-Z lower-cased words between
    white space, sets of distinct ``words``-word shingles, a link where 100 * intersection >= ``percent`` *
    union, and the smallest doc_id that links reach.

    Equal sets are one class with its smallest doc_id as representative, found by a hash aggregation.  A
    null or wordless text has an empty set and is its own component.  A row with a null doc_id has its
    n_shingles and a null component, and links with nothing.  Rows that share a doc_id are one node, and each
    is judged by its own text.  ``th`` is the xxhash64 of the row's text."""
    docs = docs.select("doc_id", "text")
    rows, classes = summarize(docs, words, percent)
    reps = rows.where("sig is not null and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"), F.first("counts").alias("counts"), F.first("n").alias("n"))
    reps = checkpointed(reps)
    links = find_links(docs, reps, classes, words, percent)
    parts = connected_components(links, "a", "b")
    named = reps.join(parts, "node", "left").select("sig", F.coalesce("component", "node").alias("component_id"))
    out = rows.join(named, "sig", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id.  Different texts that share a
    doc_id are nodes of their own, so each goes only for its own links; of rows that repeat entirely one stays,
    and of one component's rows with that doc_id the one with the smallest text hash.  Rows with a null doc_id
    all stay."""
    th = F.xxhash64("text")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("_id"), th.alias("_th"))
    several = checkpointed(texts.groupBy("_id").agg(F.min("_th").alias("lo"), F.max("_th").alias("hi")).where("lo < hi").select("_id"))
    n = several.count()
    if n:
        names = checkpointed(texts.join(broadcast_if_small(several, n), "_id", "left_semi").distinct().withColumn("_node", F.xxhash64("_id", "_th")))
        names = broadcast_if_small(names, names.count())
        own = docs.select("doc_id", "text", th.alias("_h")).join(names, (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_th")), "left")
        judged = near_duplicates(own.select(F.coalesce("_node", "doc_id").alias("doc_id"), "text"), words, percent).where("doc_id is not null")
        judged = judged.join(names.select("_node", "_id"), F.col("doc_id") == F.col("_node"), "left")
        judged = judged.select(F.coalesce("_id", "doc_id").alias("_id"), F.col("th").alias("_th"), "component_id")
        copies = judged.groupBy("component_id", "_id", "_th").agg(F.count("*").alias("_rows"))
        keep = copies.groupBy("component_id").agg(F.min(F.struct("_id", "_th", "_rows")).alias("k")).select("k.*")
    else:
        judged = near_duplicates(docs, words, percent).where("doc_id = component_id")
        keep = judged.groupBy(F.col("doc_id").alias("_id")).agg(F.min("th").alias("_th"), F.count("*").alias("_rows"))
    keep = checkpointed(keep)
    small = broadcast_if_small(keep, keep.count())
    id_, th_, rows = free_names(docs.columns, "_id", "_th", "_rows")
    small = small.select(F.col("_id").alias(id_), F.col("_th").alias(th_), F.col("_rows").alias(rows))
    kept = docs.join(small, (docs["doc_id"] == F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(th_)))
    once = kept.where(F.col(rows) == 1).select(*[docs[c] for c in docs.columns])
    again = kept.where(F.col(rows) > 1).dropDuplicates([id_, th_]).select(docs.columns)
    return once.unionByName(again).unionByName(docs.where("doc_id is null"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=85).drop("th")


_WORDS = f"regexp_extract_all(coalesce({SQL_LOWER.format('text')}, ''), '[^\\x20\\x09-\\x0D]+')"
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + least(4, len(w))), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""
