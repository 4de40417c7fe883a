"""Postings made by the tasks that read the rows: the same as those of the expression, and no row of pairs is moved."""

from __future__ import annotations

import pyarrow as pa

from docweave.operators import batches as BT
from docweave.operators import trigrams as TG
from pyspark.sql import functions as F


def test_tasks_invert_what_they_read(spark, monkeypatch):
    texts = ["Needle needle", None, "", "ab", "a\nbcd é xyz~", "KELVIN ſ İıi", "tiếng việt abc", "aaaa", "x" * 70 + "\x1f!!!", "end"]
    df = spark.createDataFrame([("a" if k < 6 else "b", k, t) for k, t in enumerate(texts)], "file string, row long, text string")
    want = {(r.file, r.gram, r.row) for r in df.select("file", "row", F.explode(TG.trigrams(F.col("text"))).alias("gram")).collect()}
    monkeypatch.setattr(TG, "PAIRS_AT_ONCE", 10)
    monkeypatch.setattr(BT, "PART_ROWS", 2)
    monkeypatch.setattr(BT, "PART_BYTES", 16)
    rows = df.select("file", "row", TG.folded(F.col("text")).alias("t")).orderBy("row").collect()
    held = pa.RecordBatch.from_pylist([r.asDict() for r in rows])
    made = [p for b in TG._invert(iter([held.slice(0, 3), held.slice(3)])) for p in b.to_pylist()]
    got = [(p["file"], p["gram"], row) for p in made for row in p["rows"]]
    assert set(got) == want and len(got) == len(want)
    assert all(p["rows"] == sorted(p["rows"]) for p in made)
    assert list(TG._invert(iter([]))) == []
