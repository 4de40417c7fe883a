"""URL filters: a trie over reversed host labels and path segments, broadcast, longest match wins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, lower_az, read, SQL_LOWER

#: (verdict, host, path prefix); a host also covers its subdomains.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: A rule's trie path is about a kilobyte; this bounds the broadcast trie to a few hundred MB.  More are joined.
MAX_RULES = 200_000


class RuleTrie:
    """Host labels from the right, then whole path segments; a rule's last segment is a prefix."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *whole, last = path.split("/")[1:] or [""]
            node = node.setdefault("path", {})
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            entry = node.setdefault("ends", {})
            if entry.get(last, ("",))[0] != "block":  # of equal rules the blocking one holds
                entry[last] = (verdict, host + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule with the most host labels, then the longest path, that fits."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "path" in node and path.startswith("/"):
                best = self._below(node["path"], path) or best
        return best

    @staticmethod
    def _below(node: dict, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path.split("/")[1:]:
            ends = node.get("ends")
            if ends:
                for n in range(min(len(segment), max(map(len, ends))), -1, -1):
                    if segment[:n] in ends:
                        best = ends[segment[:n]]
                        break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best


def url_parts(url) -> tuple:
    host = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_az(host), path


def _joined(split: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """``split`` (host and path among its columns) with ``rule`` and ``verdict`` by equi-joins: each distinct host
    and path meets the rules under its host's suffixes and its path's prefixes of the lengths that rules have."""
    good = F.col("verdict").isin("allow", "block") & (F.col("host") != "") & F.col("path").startswith("/")
    bad = F.raise_error(F.concat_ws(" ", F.lit("not a rule:"), "verdict", "host", "path"))
    rules = rules.withColumn("verdict", F.when(F.coalesce(good, F.lit(False)), F.col("verdict")).otherwise(bad))
    # of equal rules the blocking one holds
    rules = rules.groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(F.max("verdict").alias("v"))
    lengths = rules.select(F.length("p").alias("n")).distinct().agg(F.array_sort(F.collect_set("n"))).scalar()  # a url's length at most
    labels = F.split("host", r"\.")
    urls = split.select("host", "path").distinct().where("host <> '' and path like '/%'").withColumn("lengths", lengths)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    met = urls.select("host", "path", F.explode(suffixes).alias("h"), prefixes.alias("ps")).withColumn("p", F.explode("ps")).drop("ps")
    rank = F.struct(F.size(F.split("h", r"\.")), F.length("p"))
    best = met.join(rules, ["h", "p"]).groupBy("host", "path").agg(F.max(F.struct(rank.alias("rank"), "h", "p", "v")).alias("best"))
    held = best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.concat("best.h", "best.p").alias("rule"), F.col("best.v").alias("verdict"))
    host, path = free_names(split.columns, "_host", "_path")
    held = held.withColumnsRenamed({"_host": host, "_path": path})
    out = split.join(held, (split["host"] == held[host]) & (split["path"] == held[path]), "left").drop(host, path)
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def filter_urls(pages: DataFrame, rules=RULES, default: str = "allow", url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to rows with a url.

    Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there up to
    ``? #`` or the end.  A null url or one without ``://`` has empty host and path, fits no rule and gets
    ``default``.  Rules are a list on the driver or a DataFrame (verdict, host, path).  Up to MAX_RULES, counted,
    their trie is broadcast and read row by row inside Arrow batches, without a shuffle; more of them are joined
    to the urls' host suffixes and path prefixes, with the same result.  Existing columns of the four names are
    replaced; repeated rows are judged alike; whole urls of any length; an empty table gives an empty result."""
    spark = pages.sparkSession
    if isinstance(rules, DataFrame):
        rules = rules.select("verdict", "host", "path")
        many = rules.count() > MAX_RULES
        rules = rules if many else [tuple(x) for x in rules.collect()]
    else:
        rules = list(rules)
        many = len(rules) > MAX_RULES
    host, path = url_parts(F.col(url))
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    split = pages.select(*keep, host.alias("host"), path.alias("path"))
    if many:
        if not isinstance(rules, DataFrame):
            rules = spark.createDataFrame(rules, "verdict string, host string, path string")
        return _joined(split, rules, default).select(*keep, "host", "path", "rule", "verdict")
    bad = [r for r in rules if r[0] not in ("allow", "block") or not r[1] or not r[2].startswith("/")]
    if bad:
        raise ValueError(f"not a rule: {bad[0]}")
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.find
        for host, path in parts:
            found = [find(h, p) for h, p in zip(host, path, strict=True)]
            yield pd.DataFrame(
                {
                    "rule": [f and f[1] for f in found],
                    "verdict": [f[0] if f else default for f in found],
                },
                dtype=object,
            )

    (judged,) = free_names(split.columns, "_judged")
    return split.withColumn(judged, judge("host", "path")).select(*keep, "host", "path", f"{judged}.rule", f"{judged}.verdict")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


SQL = f"""
WITH p AS (
  SELECT page_id,
         coalesce({SQL_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
  END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
