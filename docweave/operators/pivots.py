"""Q3 by index: exact cosine top-k that scores a part of the points.

Points are stored by cluster: that of the nearest of a bounded number of pivot directions, with the angle to it.
Angles between directions obey the triangle inequality, so a point at angle r from a pivot that is at angle t from
the query is at least |t - r| from the query.  The clusters nearest the query give a first k-th best score; only
points that the bound lets reach that score are read after it: whole clusters are passed over by their least and
largest angle (folders that are not read), and in the others the rows outside a range of angles."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from . import vectors as VC

PIVOTS = 64
#: Angles are compared with this much room for rounding.
SLACK = 1e-6
#: Points looked at, at least, for the first threshold: so many times the limit.
FIRST_LOOK = 8
#: Cluster of the vectors whose length is not the pivots'; no bound holds for them.
OTHER = -1


def _unit(v: Sequence[float]) -> np.ndarray | None:
    x = np.asarray(v, np.float64)
    n = float(np.sqrt((x * x).sum()))
    return x / n if n > 0 and math.isfinite(n) else None


def build_index(points: DataFrame, path: str, pivots: int = PIVOTS, id_col: str = "point_id", vec_col: str = "embedding") -> None:
    """Writes ``points`` (all columns) to ``path`` by cluster.  Pivots are the vectors of the ``pivots`` smallest id
    hashes (a documented bound, 64 by default); every point with a direction is indexed, null and zero vectors,
    which never match, are not.  A cluster of any size is written by several tasks."""
    spark = points.sparkSession
    usable = points.where(F.exists(vec_col, lambda x: x != 0))
    sample = usable.select(vec_col, F.xxhash64(id_col).alias("h"), F.col(id_col).alias("i")).orderBy("h", "i").limit(pivots)
    found = [u for u in (_unit(r[vec_col]) for r in sample.collect()) if u is not None]
    dims = len(found[0]) if found else 0
    found = [u for u in found if len(u) == dims]
    matrix = np.array(found).reshape(len(found), dims)
    shared = spark.sparkContext.broadcast(matrix)
    schema = T.StructType([*points.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value
        for batch in batches:
            vectors = batch[vec_col].to_pylist()
            cluster, angle = np.full(len(vectors), OTHER, np.int32), np.zeros(len(vectors))
            own = [k for k, v in enumerate(vectors) if dims and len(v) == dims and _unit(v) is not None]
            if own:
                cosines = np.stack([_unit(vectors[k]) for k in own]) @ centers.T
                cluster[own] = cosines.argmax(1)
                angle[own] = np.arccos(np.clip(cosines.max(1), -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster), pa.array(angle)], [*batch.schema.names, "cluster", "angle"])

    placed = usable.mapInArrow(place, schema)
    placed.hint("rebalance", "cluster").sortWithinPartitions("cluster", "angle").write.partitionBy("cluster").parquet(f"{path.rstrip('/')}/points")
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{path.rstrip('/')}/schema")  # an index may be empty
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/points")
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.min("angle").alias("least"), F.max("angle").alias("most"))
    vectors = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(matrix)], "cluster int, pivot array<double>")
    sizes.join(F.broadcast(vectors), "cluster", "left").coalesce(1).write.parquet(f"{path.rstrip('/')}/clusters")


class PivotIndex:
    """A stored index: its clusters (at most the pivots and one more) are held by the driver, its points are not."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        schema = spark.read.parquet(f"{path.rstrip('/')}/schema").schema
        self.points = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/points")
        self.clusters = spark.read.parquet(f"{path.rstrip('/')}/clusters").orderBy("cluster").collect()

    def _angles(self, query: np.ndarray) -> dict[int, tuple[float, float]]:
        """cluster -> (angle of its pivot to the query, least possible angle of its points)."""
        out = {}
        for c in self.clusters:
            if c["pivot"] is None or len(c["pivot"]) != len(query):
                # vectors of another length than the query's never match; OTHER may hold some of the query's
                if c["cluster"] == OTHER:
                    out[OTHER] = (0.0, 0.0)
                continue
            t = math.acos(max(-1.0, min(1.0, float(np.dot(c["pivot"], query)))))
            out[c["cluster"]] = (t, max(0.0, t - c["most"], c["least"] - t))
        return out

    def candidates(self, query: Sequence[float], limit: int, threshold: float, fit: Column | None, vec_col: str, id_col: str) -> DataFrame:
        """The stored points that may be among the best ``limit``."""
        unit = _unit(query)
        angles = self._angles(unit) if unit is not None else {}
        if not angles or limit == 0:
            return self.points.limit(0)
        sizes = {c["cluster"]: c["n"] for c in self.clusters}
        first, seen = [], 0
        for c in sorted(angles, key=lambda c: (angles[c], c)):
            first.append(c)
            seen += sizes[c]
            if seen >= FIRST_LOOK * limit:
                break
        best = VC.vector_search(self.points.where(F.col("cluster").isin(first)), query, limit, threshold, fit, id_col, vec_col)
        scores = [r["score"] for r in best.select("score").collect()]  # at most limit
        least = max(threshold, min(scores)) if len(scores) == limit else threshold
        reach = math.acos(max(-1.0, min(1.0, least))) + SLACK
        open_ = {c: t for c, (t, bound) in angles.items() if bound <= reach}
        ranges = [(c, -1.0, 4.0) if c == OTHER else (c, t - reach, t + reach) for c, t in open_.items()]
        near = F.broadcast(self.spark.createDataFrame(ranges, "cluster int, _low double, _high double"))
        rows = self.points.where(F.col("cluster").isin(list(open_))).join(near, "cluster")
        return rows.where(F.col("angle").between(F.col("_low"), F.col("_high"))).drop("_low", "_high").select(self.points.columns)

    def search(
        self,
        query: Sequence[float],
        limit: int = S.DEFAULT_LIMIT,
        score_threshold: float = 0.0,
        filter_conditions: dict | Column | None = None,
        id_col: str = "point_id",
        vec_col: str = "embedding",
    ) -> DataFrame:
        """Q3: the same rows as ``vector_search`` over all the points, with the points' columns and ``score``."""
        fit = VC.match_filter(filter_conditions) if isinstance(filter_conditions, dict) else filter_conditions
        rows = self.candidates(query, limit, score_threshold, fit, vec_col, id_col).drop("cluster", "angle")
        return VC.vector_search(rows, query, limit, score_threshold, fit, id_col, vec_col)
