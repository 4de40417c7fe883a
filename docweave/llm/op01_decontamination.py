"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, joined with every
word window of the training texts, hits verified word by word.  DataFrame functions only."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, free_names, lower_az, read, SQL_LOWER

#: What separates words of lower-cased text; words are digits, a-z and everything above U+007F.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

#: Windows in one broadcast hash set (about 200 bytes each); a larger benchmark is scanned in blocks.
MAX_BROADCAST_WINDOWS = 500_000


def words_of(text: Column) -> Column:
    # splitting at the gaps is ten times as fast as extracting every word
    return F.coalesce(F.array_remove(F.split(lower_az(text), GAP), ""), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, len, h, items): the distinct windows of all items with the ids of the items they are in.
    An item of fewer words is one window; an item without words (or text) has none."""
    w = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice(F.col("w"), i, length))
    return (
        w.select("item_id", F.explode(grams).alias("gram"))
        .groupBy("gram")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
        .select("gram", F.size("gram").alias("len"), F.xxhash64("gram").alias("h"), "items")
    )


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per document row: doc_id, th (hash of the text), n_words, hits (array of (start, end) word
    intervals, sorted), items (distinct item ids as strings, sorted).

    Every window of every text is a row only inside the scan's own task: it is looked up in the broadcast
    set there, and only hits and one header row per document are shuffled.  The benchmark's windows are
    counted; beyond ``block`` they are looked up in hash blocks of at most that expected size, one scan
    each.  Null texts have no words; a null item_id's windows hit but name no item; repeated document
    rows each give a row; other columns are not read."""
    bench = checkpointed(benchmark_windows(benchmark.select("item_id", "text"), window))
    n = bench.count()
    lengths = sorted(r[0] for r in bench.select("len").distinct().collect()) or [window]  # at most `window` values
    w = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("w"))
    w = w.withColumn("n_words", F.size("w"))
    blocks = max(1, ceil(n / block))
    found = None
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod("h", F.lit(blocks)) == k)
        # position -1 of the first length is the document's header row
        begin = F.when((F.col("l") == lengths[0]) & F.lit(k == 0), -1).otherwise(0)
        last = F.col("n_words") - F.col("l")
        starts = F.when(last >= 0, F.sequence(begin, last)).when(begin < 0, F.array(F.lit(-1)))
        every = w.withColumn("l", F.explode(F.array(*map(F.lit, lengths)))).withColumn("pos", F.explode(starts))
        gram_here = F.slice("w", F.greatest(F.col("pos"), F.lit(0)) + 1, F.col("l"))
        every = every.withColumn("h", F.when(F.col("pos") >= 0, F.xxhash64(gram_here)))
        found_here = every.join(broadcast_if_small(part, n // blocks, 2 * block), "h", "left")
        # the hash is the only join key, so words are compared for its matches alone
        got = found_here.where((F.col("pos") < 0) | (F.col("gram") == gram_here)).select(
            "doc_id", "th", "n_words", "pos", F.col("l").alias("len"), "items"
        )
        found = got if found is None else found.unionByName(got)
    hit = F.when(F.col("pos") >= 0, F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("len")).alias("end")))
    by_doc = found.groupBy("doc_id", "th").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.sum((F.col("pos") < 0).cast("int")).alias("copies"),
    )
    # equal rows share a key: each of them is returned
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return by_doc.withColumn("copies", again).drop("copies")


def covered(hits: Column) -> Column:
    """Words inside at least one of the sorted (start, end) intervals."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        hits,
        start,
        lambda a, x: F.struct(
            F.greatest(a["end"], x["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove='spans'``) with the hit words and the text
    between neighbouring hit words cut out of them.  All columns and clean rows stay as they are."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    hit = find_hits(docs, benchmark, window).where(F.size("hits") > 0)
    id_, th, hits, pieces = free_names(docs.columns, "_id", "_th", "_hits", "_pieces")
    hit = checkpointed(hit.select(F.col("doc_id").alias(id_), F.col("th").alias(th), F.col("hits").alias(hits)).distinct())
    small = broadcast_if_small(hit, hit.count())
    on = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(th))
    if remove == "documents":
        return docs.join(small, on, "left_anti")
    either = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
    parts = F.regexp_extract_all(F.col("text"), F.lit(either), F.lit(0))
    joined = docs.join(small, on, "left").withColumn(pieces, F.when(F.col(hits).isNotNull(), parts))
    lead = F.when(F.element_at(pieces, 1).rlike(r"^[0-9A-Za-z\x{80}-\x{10FFFF}]"), 0).otherwise(1)

    def outside(_, j):
        word = F.floor((j - lead) / 2)
        is_word = F.pmod(j - lead, F.lit(2)) == 0
        # a gap goes when the words on both sides of it are inside one hit
        inside = F.exists(hits, lambda x: (x["start"] <= word) & (F.when(is_word, word).otherwise(word + 1) < x["end"]))
        return ~inside

    cut = F.when(F.col(hits).isNull(), F.col("text")).otherwise(F.array_join(F.filter(pieces, outside), ""))
    return joined.select(*[cut.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_W = f"regexp_extract_all(coalesce({SQL_LOWER.format('text')}, ''), '{GAP.replace('[', '[^', 1)}')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_W} AS w FROM documents),
b AS (SELECT item_id, {_W} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, list_slice(w, i + 1, i + least({WINDOW}, len(w))) AS gram
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(gram) AS l FROM g),
dw AS (
  SELECT rid, i, l, list_slice(w, i + 1, i + l) AS gram
  FROM (SELECT rid, w, l, unnest(range(0, len(w) - l + 1)) AS i FROM d, lens)),
hit AS (SELECT rid, i, l, item_id FROM dw JOIN g USING (gram)),
words AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
