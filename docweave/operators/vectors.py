"""Q3 vector search, W5-W8 point maintenance, T3-T6 embedding and vectorisation, A4 collection info.

Points are a DataFrame ``(point_id, embedding array<float>, payload columns...)``.  Cosine scores
are exact (no approximate index).

* One query vector: a JVM expression per row, then ``orderBy(score desc, point_id).limit(k)``,
  which Spark runs as TakeOrderedAndProject: each task keeps its own top k, so only
  ``k x tasks`` rows reach the final merge.
* Many query vectors: the query batch is size-checked, broadcast, and every points partition
  scores its rows against all queries with one matrix product in an Arrow batch, keeping its own
  top k per query (ties kept); a ``row_number`` per query then merges.  Nothing pairs every point
  with every query in a shuffle.  Query batches beyond the bound are processed in several passes.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import text as TX
from ..session import bound_batches, reliable_checkpoint
from .batches import map_batches, regrouped

MAX_QUERIES_PER_PASS = 2048  # broadcast bound: 2048 x 768 doubles = 12.6 MB


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def _norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda acc, v: acc + v))


def cosine(embedding: Column, query: Column) -> Column:
    """Cosine similarity; null when either side is null, sizes differ, or a norm is zero."""
    den = _norm(embedding) * _norm(query)
    ok = embedding.isNotNull() & query.isNotNull() & (F.size(embedding) == F.size(query)) & (den > 0)
    return F.when(ok, _dot(embedding, query) / den)


def _as_vector(query) -> Column:
    if isinstance(query, Column):
        return query
    return F.array(*[F.lit(float(x)) for x in query])


def match_filter(conditions: dict | None) -> Column | None:
    """Payload filter as equality on every given field (``must`` semantics)."""
    if not conditions:
        return None
    pred = None
    for k, v in conditions.items():
        c = F.col(k) == F.lit(v)
        pred = c if pred is None else (pred & c)
    return pred


def vector_search(
    points: DataFrame,
    query,
    limit: int = S.DEFAULT_LIMIT,
    score_threshold: float = 0.0,
    filter_conditions: dict | Column | None = None,
    id_col: str = "point_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Q3: points with ``score >= score_threshold`` (cosine) that pass the filter, best ``limit``
    first (ties by id).  Output: the point's columns without the vector, plus ``score``."""
    if limit < 0:
        raise ValueError("limit must be non-negative")
    q = _as_vector(query)
    pts = points
    pred = match_filter(filter_conditions) if isinstance(filter_conditions, dict) else filter_conditions
    if pred is not None:
        pts = pts.where(pred)  # payload filter first: pushed to the scan where possible
    # The query vector becomes a column first, so it may also be a scalar subquery.
    scored = pts.withColumn("_qv", q).withColumn("score", cosine(F.col(vec_col), F.col("_qv"))).drop("_qv", vec_col)
    # The threshold comes after the top k (the same rows, as both follow the score): a filter below the sort
    # would have the cosine computed twice.
    best = scored.orderBy(F.col("score").desc_nulls_last(), F.col(id_col)).limit(limit)
    return best.where(F.col("score") >= F.lit(score_threshold))


def vector_search_batch(
    points: DataFrame,
    queries: DataFrame,
    k: int = S.DEFAULT_LIMIT,
    score_threshold: float = 0.0,
    id_col: str = "point_id",
    vec_col: str = "embedding",
    query_id_col: str = "query_id",
    query_vec_col: str = "query_vector",
    payload_cols: Sequence[str] = (),
    max_queries_per_pass: int = MAX_QUERIES_PER_PASS,
) -> DataFrame:
    """Q3 for many query vectors: ``(query_id, point_id, payload..., score)``, the best ``k`` per
    query with ``score >= score_threshold``, ties by point id.  Query ids must be unique and not null (checked);
    ``max_queries_per_pass`` bounds what is broadcast at once, and each pass scans the points."""
    spark = points.sparkSession
    bound_batches(spark)
    q = queries.select(F.col(query_id_col).alias("query_id"), F.col(query_vec_col).alias("qv")).where(F.col("qv").isNotNull())
    # size check before anything is broadcast
    n_queries, n_ids = q.agg(F.count("*"), F.countDistinct("query_id")).first()
    if n_ids < n_queries:
        raise ValueError("query ids must be unique and not null")
    payload_cols = list(payload_cols)
    pts = points.select(F.col(id_col).alias("point_id"), F.col(vec_col).alias("_v"), *payload_cols).where(F.col("_v").isNotNull())
    qid_type = q.schema["query_id"].dataType
    out_schema = T.StructType(
        [T.StructField("query_id", qid_type), T.StructField("point_id", pts.schema["point_id"].dataType)]
        + [pts.schema[c] for c in payload_cols]
        + [T.StructField("score", T.DoubleType())]
    )
    results = []
    for part in _query_passes(q, n_queries, max_queries_per_pass):
        local = part.toPandas()  # at most max_queries_per_pass rows (checked in _query_passes)
        if len(local) == 0:
            continue
        qids = local["query_id"].tolist()
        Q = np.stack([np.asarray(v, dtype=np.float64) for v in local["qv"]])
        qn = np.linalg.norm(Q, axis=1)
        keep = qn > 0
        qids = [x for x, ok in zip(qids, keep) if ok]
        Qn = (Q[keep] / qn[keep, None]).T.copy()  # d x m
        bc = spark.sparkContext.broadcast((qids, Qn))
        results.append(pts.mapInPandas(_partition_topk(bc, k, score_threshold, payload_cols), out_schema))
    if not results:
        return spark.createDataFrame([], out_schema)
    allr = results[0]
    for r in results[1:]:
        allr = allr.unionByName(r)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("point_id"))
    return allr.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def _query_passes(q: DataFrame, n_queries: int, bound: int) -> list[DataFrame]:
    """Split the query batch into passes of at most ``bound`` queries each.  Queries are hashed into
    buckets, bucket sizes are counted (a small aggregate), and buckets are packed into passes, so
    every broadcast has a checked size."""
    if n_queries <= bound:
        return [q]
    n_buckets = 4 * -(-n_queries // bound)
    b = F.pmod(F.xxhash64("query_id"), F.lit(n_buckets))
    counts = sorted(q.groupBy(b.alias("b")).count().collect(), key=lambda r: -r["count"])
    passes: list[tuple[int, list[int]]] = []
    for r in counts:
        if r["count"] > bound:  # unique ids spread: far more than a quarter of the bound in one bucket is no accident
            raise ValueError("the query ids hash too unevenly")
        for i, (size, members) in enumerate(passes):
            if size + r["count"] <= bound:
                passes[i] = (size + r["count"], members + [r["b"]])
                break
        else:
            passes.append((r["count"], [r["b"]]))
    return [q.where(b.isin(members)) for _, members in passes]


#: Scores that a task holds at once (8 MB).
SCORES_AT_ONCE = 1 << 20


def _partition_topk(bc, k: int, threshold: float, payload_cols: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Scores slices of a batch's rows and holds the best ``k`` of each query so far.  Rows come by point id, so a
    row's place in its batch orders equal scores; a query with ``k`` rows takes only what reaches the last of them."""
    cols = ["point_id"] + payload_cols

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, Qn = bc.value
        dim, m = Qn.shape
        cut = np.full(m, threshold, dtype=np.float64)
        kept: pd.DataFrame | None = None
        for pdf in batches:
            ok = pdf["_v"].map(lambda v: v is not None and len(v) == dim).to_numpy(dtype=bool)
            if not ok.any() or not m:
                continue
            pdf = pdf[ok].sort_values("point_id", kind="stable", ignore_index=True)
            n = max(1, SCORES_AT_ONCE // m)
            for at in range(0, len(pdf), n):
                found = _slice_topk(pdf.iloc[at : at + n].reset_index(drop=True), Qn, k, cut, cols)
                if found is None:
                    continue
                kept = found if kept is None else _topk_per_query(pd.concat([kept, found], ignore_index=True), k)
                last = kept.groupby("_q")["score"].agg(["size", "min"])
                full = last[last["size"] == k]
                cut[full.index] = np.maximum(threshold, full["min"])
        if kept is not None:
            kept.insert(0, "query_id", [qids[j] for j in kept["_q"]])
            yield kept.drop(columns="_q")

    return run


def _slice_topk(rows: pd.DataFrame, Qn: np.ndarray, k: int, cut: np.ndarray, cols: list[str]) -> pd.DataFrame | None:
    """The best ``k`` of the rows (by score, then as they come) of each query, of those that reach its ``cut``."""
    P = np.stack([np.asarray(v, dtype=np.float64) for v in rows["_v"]])
    pn = np.linalg.norm(P, axis=1)
    nz = np.flatnonzero(pn > 0)
    scores = (P[nz] / pn[nz, None]) @ Qn  # n x m
    hit = scores >= cut[None, :]
    if len(nz) > k > 0 and np.count_nonzero(hit) > 4 * k * len(cut):
        hit &= scores >= np.partition(scores, len(nz) - k, axis=0)[len(nz) - k]  # ties of the k-th best stay
    ri, qi = np.nonzero(hit)
    order = np.lexsort((ri, -scores[ri, qi], qi))
    ri, qi = ri[order], qi[order]
    starts = np.flatnonzero(np.diff(qi, prepend=-1))
    place = np.arange(len(qi)) - np.repeat(starts, np.diff(starts, append=len(qi)))
    ri, qi = ri[place < k], qi[place < k]
    if not len(ri):
        return None
    found = rows.loc[nz[ri], cols].reset_index(drop=True)
    found.insert(0, "_q", qi)
    found["score"] = scores[ri, qi]
    return found


def _topk_per_query(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    frame = frame.sort_values(["_q", "score", "point_id"], ascending=[True, False, True])
    return frame.groupby("_q", sort=False).head(k)


# ---------------------------------------------------------------------------------------------
# Points: build, upsert, delete, info
# ---------------------------------------------------------------------------------------------


def point_id(source: Column, chunk_index: Column, kind: str = "file") -> Column:
    """Deterministic UUID-shaped id of (kind, source, chunk index): stable across retries and re-runs, so
    re-vectorising a file overwrites its points, and a file's text and its summary have points of their own."""
    h = F.md5(F.concat_ws("#", F.lit(kind), source, chunk_index.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def check_dimension(points: DataFrame, dim: int, vec_col: str = "embedding") -> DataFrame:
    """The collection's vector size as a row-level assertion (fails the job on a mismatch)."""
    bad = F.col(vec_col).isNotNull() & (F.size(vec_col) != dim)
    return points.withColumn(vec_col, F.when(bad, F.raise_error(F.lit(f"vector size must be {dim}"))).otherwise(F.col(vec_col)))


def build_points(
    embedded_chunks: DataFrame,
    source: Column,
    vec_col: str = "embedding",
    upload_ts: Column | None = None,
    kind: str = "file",
    metadata: Column | None = None,
) -> DataFrame:
    """Chunks with vectors -> points.  Chunks without a vector are dropped; the other
    chunks keep their original index (gaps stay).  ``metadata`` is a free map<string,string> of the caller."""
    ts = upload_ts if upload_ts is not None else F.current_timestamp()
    return embedded_chunks.where(F.col(vec_col).isNotNull()).select(
        point_id(source, F.col("chunk_index"), kind).alias("point_id"),
        F.col(vec_col).alias("embedding"),
        F.col("chunk_text").alias("text"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        TX.local_iso(ts).alias("upload_timestamp"),
        F.length("chunk_text").cast("int").alias("text_length"),
        source.alias("source"),
        F.lit(kind).alias("kind"),
        (F.lit(None) if metadata is None else metadata).cast("map<string,string>").alias("metadata"),
    )


def upsert_points(
    existing: DataFrame, new: DataFrame, id_col: str = "point_id", newest: str = "upload_timestamp", whole: Sequence[str] = ()
) -> DataFrame:
    """W6 upsert: new points replace existing ones with the same id; of new points that share an id the newest
    stays.  With ``whole`` (say source and kind) a new group replaces all existing points of that group, so a
    file that got shorter leaves no stale tail."""
    plain = [f.name for f in new.schema.fields if not isinstance(f.dataType, T.MapType)]
    last = Window.partitionBy(id_col).orderBy(*([F.desc_nulls_last(newest)] if newest in new.columns else []), F.xxhash64(*plain))
    new = new.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    kept = existing.join(new.select(id_col).distinct(), on=id_col, how="left_anti")
    if whole:
        kept = kept.join(new.select(*whole).distinct(), on=list(whole), how="left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def delete_by_filter(points: DataFrame, predicate: Column | dict) -> DataFrame:
    """The points that remain after deleting those matching ``predicate`` (a null predicate
    keeps the row)."""
    pred = match_filter(predicate) if isinstance(predicate, dict) else predicate
    return points.where(~F.coalesce(pred, F.lit(False)))


# A stored collection: points in files by hash bucket of their source, and a manifest that names the
# folder of each bucket's current rows.  A write puts the rows of the buckets it touches into a new folder
# and then replaces the manifest in one rename, so readers see the old or the new state and a crash loses
# nothing.
BUCKETS = 64
MANIFEST = "manifest.json"


def _hadoop(spark, path: str):
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, conf


def _manifest(spark, path: str) -> dict | None:
    name = path.rstrip("/") + "/" + MANIFEST
    fs, p, _ = _hadoop(spark, name)
    return json.loads(spark.read.text(name, wholetext=True).first()[0]) if fs.exists(p) else None


def _replace_manifest(spark, path: str, manifest: dict) -> None:
    name = path.rstrip("/") + "/" + MANIFEST
    fs, target, conf = _hadoop(spark, name)
    _, staged, _ = _hadoop(spark, f"{name}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    files.rename(fs.makeQualified(staged), fs.makeQualified(target), options)


def ensure_collection(spark, path: str, dim: int) -> None:
    """Create the collection with its vector size; an existing one must have the same."""
    held = _manifest(spark, path)
    if held is None:
        _replace_manifest(spark, path, {"dim": dim, "buckets": {}})
    elif held["dim"] != dim:
        raise ValueError(f"the collection's vector size is {held['dim']}, not {dim}")


def _bucket(source: Column) -> Column:
    return F.pmod(F.xxhash64(source), F.lit(BUCKETS)).cast("int")


def _read_buckets(spark, path: str, manifest: dict, buckets: Sequence[str]) -> DataFrame:
    folders = [f"{path.rstrip('/')}/{manifest['buckets'][b]}" for b in buckets if b in manifest["buckets"]]
    return spark.read.schema(S.POINT_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], S.POINT_SCHEMA)


def read_points(spark, path: str) -> DataFrame:
    """The current points of a stored collection."""
    manifest = _manifest(spark, path)
    if manifest is None:
        raise ValueError(f"no collection at {path}")
    return _read_buckets(spark, path, manifest, sorted(manifest["buckets"]))


def _write_buckets(spark, path: str, manifest: dict, rows: DataFrame, touched: Sequence[str]) -> None:
    run = uuid.uuid4().hex
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.POINT_SCHEMA.fields]
    data = rows.select(*columns, _bucket(F.col("source")).alias("bucket"))
    data.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path.rstrip('/')}/data-{run}")
    fs, _, _ = _hadoop(spark, path)
    buckets = dict(manifest["buckets"])
    for b in touched:  # at most BUCKETS entries
        folder = f"data-{run}/bucket={b}"
        if fs.exists(_hadoop(spark, f"{path.rstrip('/')}/{folder}")[1]):
            buckets[b] = folder
        else:
            buckets.pop(b, None)
    _replace_manifest(spark, path, manifest | {"buckets": buckets})


def save_points(points: DataFrame, path: str, dim: int | None = None) -> None:
    """W5/W6 on storage: upsert whole sources into the collection (created if need be, with the given size or
    that of the points).  Only the hash buckets of the points' sources are read and written anew."""
    spark = points.sparkSession
    points = points.select(*[c if c in points.columns else F.lit(None).cast(S.POINT_SCHEMA[c].dataType).alias(c) for c in S.POINT_SCHEMA.names])
    held = _manifest(spark, path)
    if dim is None:
        dim = held["dim"] if held else points.agg(F.max(F.size("embedding"))).first()[0]
        if dim is None:
            return  # no point, and no collection to be of one size with
    ensure_collection(spark, path, dim)
    manifest = _manifest(spark, path)
    new = check_dimension(points, dim)
    touched = sorted(str(r[0]) for r in new.select(_bucket(F.col("source"))).distinct().collect())
    merged = upsert_points(_read_buckets(spark, path, manifest, touched), new, whole=("source", "kind"))
    _write_buckets(spark, path, manifest, merged, touched)


def delete_points(spark, path: str, predicate: Column | dict) -> None:
    """W7 on storage: delete the points that match; only buckets with a match are written anew."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return
    pred = match_filter(predicate) if isinstance(predicate, dict) else predicate
    hit = read_points(spark, path).where(pred).select(_bucket(F.col("source"))).distinct().collect()
    touched = sorted(str(r[0]) for r in hit)
    if touched:
        _write_buckets(spark, path, manifest, delete_by_filter(_read_buckets(spark, path, manifest, touched), pred), touched)


def drop_collection(spark, path: str) -> bool:
    """Delete the whole collection; False when there was none."""
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hp) and fs.delete(hp, True))


def collection_info(points: DataFrame, name: str = S.COLLECTION_NAME, vec_col: str = "embedding") -> DataFrame:
    """A4: name, status, vectors_count, points_count, vector_size, distance (one pass)."""
    return points.agg(
        F.lit(name).alias("name"),
        F.lit("green").alias("status"),
        F.count(vec_col).alias("vectors_count"),
        F.count(F.lit(1)).alias("points_count"),
        F.max(F.size(vec_col)).alias("vector_size"),
        F.lit("Cosine").alias("distance"),
    )


def points_success(points: DataFrame, group_col: str = "source", vec_col: str = "embedding") -> DataFrame:
    """T4: per source, how many chunks got a vector, and success = at least one."""
    g = points.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("chunks"), F.count(vec_col).alias("points_written")
    )
    return g.withColumn("success", F.col("points_written") > 0)


def files_uploaded(success: DataFrame) -> DataFrame:
    """Of the sources in ``points_success``: how many there are, how many were uploaded, and the overall
    flag (at least one)."""
    n = F.count_if("success")
    return success.agg(F.count("*").alias("files"), n.alias("uploaded"), (n > 0).alias("success"))


# ---------------------------------------------------------------------------------------------
# T3 embedding with an injected embedder
# ---------------------------------------------------------------------------------------------

Embedder = Callable[[list[str]], list]


def hashing_embedder(dim: int = 64) -> Embedder:
    """Deterministic test embedder: signed feature hashing of lower-cased words, L2-normalised.
    Stands in for a hosted model in tests and benchmarks."""

    import re

    word = re.compile(r"\w+")

    def embed(texts: list[str]) -> list:
        out = []
        for t in texts:
            v = np.zeros(dim, dtype=np.float32)
            for w in word.findall(t.lower()):
                h = zlib.crc32(w.encode("utf-8"))
                v[h % dim] += 1.0 if (h >> 16) & 1 else -1.0
            n = float(np.linalg.norm(v))
            out.append((v / n).tolist() if n > 0 else None)
        return out

    return embed


def md5_embedder(texts: list[str]) -> list:
    """Stand-in for a model whose vectors SQL can repeat: the bytes of the text's MD5, less 128."""
    return [[float(b - 128) for b in hashlib.md5(t.encode()).digest()] for t in texts]


def embed_isolated(embedder: Embedder, texts: list[str]) -> list:
    """Vectors of a batch; if the call fails, text by text, so that only what fails alone has none."""
    try:
        got = embedder(texts)
        if len(got) != len(texts):
            raise ValueError("embedder returned a different number of vectors")
        return list(got)
    except Exception:  # noqa: BLE001 - a text that fails has no vector
        return [None] if len(texts) == 1 else [v for t in texts for v in embed_isolated(embedder, [t])]


def embed_chunks(
    chunks: DataFrame,
    embedder: Embedder,
    text_col: str = "chunk_text",
    out_col: str = "embedding",
    batch_size: int = 64,
    pause_seconds: float = 0.0,
) -> DataFrame:
    """Adds ``out_col`` (array<float>) by calling ``embedder`` on batches of texts inside the
    tasks.  After a failing call its texts are tried one by one; one that fails alone gets a null (the job goes
    on).  A task waits ``pause_seconds`` before each call, also of those one by one, so the calls of all tasks
    together come at no more than tasks / pause a second."""
    out_schema = T.StructType(list(chunks.schema.fields) + [T.StructField(out_col, T.ArrayType(T.FloatType()))])
    at = chunks.columns.index(text_col)

    def paced(texts: list[str]) -> list:
        if pause_seconds:
            time.sleep(pause_seconds)
        return embedder(texts)

    names = out_schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, batch_size):
            texts = part.column(at).to_pylist()
            vecs = embed_isolated(paced, [t if t is not None else "" for t in texts])
            vectors = pa.array(vecs, pa.list_(pa.float32()), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*part.columns, vectors], names)

    return map_batches(chunks, run, out_schema)


# A content-addressed store of vectors: one row for each (model, text) that was ever embedded.
VECTORS = "text_hash string, embedding array<float>, model string"


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def stored_vectors(spark, path: str, model: str) -> DataFrame:
    """(text_hash, embedding) of a model's vectors in the store."""
    fs, p, _ = _hadoop(spark, path)
    held = spark.read.schema(VECTORS).parquet(path) if fs.exists(p) else spark.createDataFrame([], VECTORS)
    return held.where(F.col("model") == model).select("text_hash", "embedding")


def embed_reusing(
    chunks: DataFrame,
    embedder: Embedder,
    store: str,
    model: str,
    text_col: str = "chunk_text",
    out_col: str = "embedding",
    batch_size: int = 64,
    calls_per_second: float | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """T3 with a memory: adds ``out_col`` like ``embed_chunks``, but asks the embedder only for texts that ``store``
    has no vector of ``model`` for, each distinct text once.

    New vectors are appended to the store before the result is read from it, so neither a second run nor a lost
    executor calls the model again.  A text that fails has no vector, is not stored, and is tried by the next run;
    a null text counts as empty.  With ``calls_per_second`` the calls of all tasks together stay under that rate, but
    for one call a task at once: the distinct texts are dealt to ``tasks`` tasks (the session's parallelism by default) and each spends its
    share of the rate, whatever the number of texts.  A hot text is embedded once and its vector is joined to every
    chunk by hash; AQE splits the skewed side."""
    spark = chunks.sparkSession
    hashed = chunks.withColumn("_hash", text_hash(F.col(text_col)))
    texts = hashed.groupBy("_hash").agg(F.first(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    held = stored_vectors(spark, store, model)
    new = texts.join(held.select(F.col("text_hash").alias("_hash")), "_hash", "left_anti")
    tasks = tasks or spark.sparkContext.defaultParallelism
    pause = tasks / calls_per_second if calls_per_second else 0.0
    made = embed_chunks(new.repartition(tasks), embedder, "_text", "_vector", batch_size, pause).where("_vector is not null")
    rows = reliable_checkpoint(made.select(F.lit(model).alias("model"), F.col("_hash").alias("text_hash"), F.col("_vector").alias("embedding")))
    if not rows.isEmpty():
        rows.hint("rebalance").write.mode("append").partitionBy("model").parquet(store)
    vectors = stored_vectors(spark, store, model).groupBy(F.col("text_hash").alias("_hash")).agg(F.first("embedding").alias(out_col))
    return hashed.drop(out_col).join(vectors, "_hash", "left").drop("_hash")
