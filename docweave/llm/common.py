"""Helpers shared by the operators of this subpackage: table reads, lineage cuts in the cluster's
shared folder, size-checked broadcasts, connected components, and word hashing for Python stages."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bound_batches, bound_bytes, ensure_checkpoint_dir, reliable_checkpoint  # noqa: F401 - used by the operators

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SQL_LOWER = f"translate({{}}, '{UPPER}', '{LOWER}')"

#: A frame of narrow keys is broadcast only when its counted rows stay under this bound.
MAX_BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-cases A-Z only.  For all-ASCII text ``lower`` does the same and is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, each with underscores added until no column has it (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shielded(df: DataFrame, reserved: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that are named like a ``reserved`` one (in any case) under other names, and the name
    that each of its columns has now."""
    clash = {c.lower() for c in reserved}
    own = [c for c in df.columns if c.lower() in clash]
    others = [c for c in df.columns if c.lower() not in clash]
    now = dict(zip(own, free_names([*others, *reserved], *own), strict=True))
    names = {c: now.get(c, c) for c in df.columns}
    return df.select(*[F.col(c).alias(n) for c, n in names.items()]), names


def checkpointed(df: DataFrame) -> DataFrame:
    return reliable_checkpoint(df)


def staged(df: DataFrame) -> DataFrame:
    """Cuts lineage of a wide frame through a compressed table in the cluster's shared checkpoint
    folder (a plain checkpoint writes rows uncompressed)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hints a broadcast for a narrow frame whose rows were counted; beyond the bound Spark's own
    shuffle join (with AQE's skew handling) runs instead, with the same result."""
    return F.broadcast(df) if rows <= limit else df


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node with a link to another.

    Alternates large-star and small-star steps over an edge table: each step joins every edge with the
    smallest neighbour of its upper end, so a chain shrinks geometrically and no group of links is ever
    gathered in one task.  Each round is checkpointed in the shared folder."""

    def settle(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = checkpointed(df.distinct())
        r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        return df, tuple(r)

    edge, mark = settle(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    )
    while mark[0]:
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, new_mark = settle(small.unionByName(least.select("u", F.col("m").alias("v"))))
        if new_mark == mark:
            break
        edge, mark = new, new_mark
    roots = edge.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edge.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


class WordHash(dict):
    """64-bit hash of each word, remembered per worker; emptied when it has grown past a bound."""

    LIMIT = 1 << 17

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift), vectorised."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_factors(n: int) -> np.ndarray:
    """n fixed odd 64-bit factors."""
    return mix(np.arange(1, n + 1, dtype=np.uint64), 7) | np.uint64(1)
