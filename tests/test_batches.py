"""Python stages in parts: what a task holds does not follow the rows of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

from docweave.operators import batches as BT
from docweave.operators import chunk as CH
from docweave.operators import keywords as KW
from docweave.operators import vectors as VC


def _sent(stage, df, monkeypatch, make):
    """The rows of each batch that the stage's own function gives for one Arrow batch with all rows of ``df``."""
    sizes = []

    def taken(frame, run, schema):
        sizes.extend(b.num_rows for b in run(iter([pa.RecordBatch.from_pylist([r.asDict() for r in frame.collect()])])))
        return frame

    monkeypatch.setattr(stage, "map_batches", taken)
    make(df)
    return sizes


def test_word_frequency_leaves_in_parts(spark, monkeypatch):
    text = " ".join("".join(chr(97 + (k // 26**p) % 26) for p in range(4)) for k in range(9000))
    df = spark.createDataFrame([(k, text) for k in range(3)] + [(9, None)], "doc_id long, text string")
    sizes = _sent(BT, df, monkeypatch, KW.word_frequency)
    assert sum(sizes) == 27000 and max(sizes) <= BT.OUT_ROWS
    monkeypatch.undo()
    assert KW.word_frequency(df).groupBy("doc_id").count().collect() and KW.word_frequency(df).count() == 27000


def test_chunks_leave_in_parts(spark, monkeypatch):
    df = spark.createDataFrame([(k, "word " * 400) for k in range(1000)], "doc_id long, text string")
    sizes = _sent(BT, df, monkeypatch, CH.chunk_text)
    monkeypatch.undo()
    assert sum(sizes) == CH.chunk_text(df).count() and max(sizes) <= 3 * BT.PART_ROWS


def test_embedder_gets_whole_batches_and_hands_each_on(spark, monkeypatch):
    df = spark.createDataFrame([(k, f"t{k}") for k in range(300)], "chunk_index long, chunk_text string")
    sizes = _sent(VC, df, monkeypatch, lambda d: VC.embed_chunks(d, VC.md5_embedder))
    assert sizes == [64, 64, 64, 64, 44]
    held = pa.RecordBatch.from_pylist([{"a": k} for k in range(10)])
    assert [b.num_rows for b in BT.regrouped(iter([held, held.slice(0, 0), held]), 8)] == [8, 8, 4]
    assert [x for b in BT.regrouped(iter([held, held]), 8) for x in b["a"].to_pylist()] == [*range(10), *range(10)]


def test_parts_are_bounded_by_bytes():
    held = pa.RecordBatch.from_pylist([{"t": "x" * 10_000} for _ in range(1000)] + [{"t": "y" * (2 * BT.PART_BYTES)}])
    found = list(BT.parts(iter([held])))
    assert sum(b.num_rows for b in found) == 1001
    assert all(b.nbytes <= BT.PART_BYTES for b in found if b.num_rows > 1)


def test_batched_search_scores_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    P, Q = rng.normal(size=(500, 4)), rng.normal(size=(30, 4))
    P[100:300] = P[100]  # a large group of copies: ties go by id
    P[7] = 0
    monkeypatch.setattr(VC, "SCORES_AT_ONCE", 600)
    sizes, one = [], VC._slice_topk

    def slice_topk(rows, *rest):
        sizes.append(len(rows))
        return one(rows, *rest)

    monkeypatch.setattr(VC, "_slice_topk", slice_topk)
    ids = rng.permutation(500)
    frame = pd.DataFrame({"point_id": [f"p{i:03}" for i in ids], "_v": list(P)})
    Qn = (Q / np.linalg.norm(Q, axis=1)[:, None]).T.copy()

    class Shared:
        value = ([f"q{j}" for j in range(30)], Qn)

    got = pd.concat(VC._partition_topk(Shared, 10, 0.0, [])(iter([frame[:260], frame[260:]])))
    assert max(sizes) == 20
    with np.errstate(invalid="ignore"):
        S = np.round(P / np.linalg.norm(P, axis=1)[:, None] @ Qn, 9)
    for j in range(30):
        best = sorted((-S[i, j], f"p{ids[i]:03}") for i in range(500) if i != 7 and S[i, j] >= 0)[:10]
        mine = got[got["query_id"] == f"q{j}"]
        assert sorted(zip((-mine["score"]).round(9), mine["point_id"])) == best
