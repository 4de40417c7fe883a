import pytest
from pyspark.sql import functions as F

from docweave.functions import decode as DC
from docweave.operators import chunk as CH


def test_decode_cascade(spark):
    cases = [
        (b"caf\xc3\xa9", "café", "utf-8"),
        (b"caf\xe9", "慣", "utf-16"),  # even length, not UTF-8: decodes as UTF-16 (little-endian)
        (b"\xff\xfeh\x00\xe9\x00", "hé", "utf-16"),  # BOM removed
        (b"\xfe\xff\x00h\x00\xe9", "hé", "utf-16"),  # big-endian BOM
        (b"h\x00\xe9\x00", "hé", "utf-16"),  # UTF-16LE without BOM (not valid UTF-8)
        (b"h\x00i\x00", "h\x00i\x00", "utf-8"),  # valid UTF-8 (with NULs) wins
        (b"\x00\xd8A\x00", "\x00ØA\x00", "latin-1"),  # unpaired surrogate: not UTF-16
        (b"\xe9", "é", "latin-1"),  # odd length
        (b"\xef\xbb\xbfabc", "﻿abc", "utf-8"),  # UTF-8 BOM kept
        (b"", "", "utf-8"),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, (b, _, _) in enumerate(cases)], "i int, b binary")
    got = [tuple(r) for r in df.orderBy("i").select(DC.decode_bytes("b").alias("d")).select("d.text", "d.encoding").collect()]
    assert got == [(t, e) for _, t, e in cases]


EDGE_TEXTS = [
    "",
    "short text",
    "x" * 1000,
    "x" * 1001,
    "y" * 2500,
    "a" * 999 + "." + "b" * 600,  # '.' just inside the window
    "." + "c" * 1500,  # '.' at start: not a boundary
    "d" * 500 + "." + "e" * 1200,  # last '.' before 799: gap
    ("word " * 400).strip(),
    " " * 1200,
    ("Sentence one is here. " * 120),
    "z" * 1700 + " tail",
]


def test_chunk_forms_agree_with_rule(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE_TEXTS)], "doc_id long, text string")
    a = sorted(tuple(r) for r in CH.chunk_text(df, method="arrow").collect())
    n = sorted(tuple(r) for r in CH.chunk_text(df, method="native").collect())
    assert a == n
    expected = sorted(
        (i, j, s, (t if len(t) <= 1000 else t[s:e].strip()))
        for i, t in enumerate(EDGE_TEXTS)
        for j, (s, e) in enumerate(CH.chunk_spans(t))
    )
    assert a == expected


def test_chunk_known_values():
    assert CH.chunk_strings("") == [""]
    assert CH.chunk_strings("x" * 1000) == ["x" * 1000]
    assert [len(c) for c in CH.chunk_strings("x" * 1001)] == [1001]
    assert [len(c) for c in CH.chunk_strings("y" * 2500)] == [1001, 1001, 498]
    # gap: boundary at 500, next start is 800, so characters 501..799 are in no chunk
    t = "d" * 500 + "." + "e" * 1200
    assert CH.chunk_spans(t) == [(0, 501), (800, 1701), (1600, 1701)]
    # a long tail is followed by one more chunk inside it
    t2 = "f" * 999 + " " + "g" * 950
    assert CH.chunk_spans(t2) == [(0, 1000), (1000, 1950), (1800, 1950)]
    assert CH.chunk_strings(" " * 1200) == ["", ""]


def test_chunk_params(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        CH.chunk_text(df, overlap=1000)
    with pytest.raises(ValueError):
        CH.chunk_text(df, chunk_size=0)


def test_chunks_are_substrings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ch = CH.chunk_text(df.select("doc_id", "text"))
    j = ch.join(df.select("doc_id", "text"), "doc_id")
    bad = j.where(F.instr("text", F.col("chunk_text")) == 0).count()
    assert bad == 0
    # chunk_index is dense per document
    gaps = ch.groupBy("doc_id").agg((F.max("chunk_index") + 1 - F.count("*")).alias("g")).where("g != 0").count()
    assert gaps == 0


def test_chunk_single_span_longer_than_size(spark):
    # " " + 1000 x: one span of 1001 characters (the space at the window start is no boundary),
    # longer than the chunk size, so it is stripped; 1000 blanks are one chunk kept as is
    df = spark.createDataFrame([(1, " " + "x" * 1000), (2, " " * 1000), (3, " " * 1001)], "doc_id long, text string")
    for method in ("arrow", "native"):
        got = sorted((r.doc_id, r.chunk_text) for r in CH.chunk_text(df, method=method).collect())
        assert got == [(1, "x" * 1000), (2, " " * 1000), (3, ""), (3, "")]


def test_covering_mode(spark):
    for text in EDGE_TEXTS:
        spans = CH.chunk_spans(text, 100, 20, mode="covering")
        covered = set().union(*(range(a, b) for a, b in spans))
        assert covered == set(range(len(text))) and spans[-1][1] == len(text)
        assert all(b - a <= 101 for a, b in spans) and all(a < c for (a, _), (c, _) in zip(spans, spans[1:]))
    df = spark.createDataFrame([(1, "One. " * 100)], "doc_id long, text string")
    assert CH.chunk_text(df, chunk_size=50, overlap=10, mode="covering").count() > 10
    with pytest.raises(ValueError):
        CH.chunk_text(df, method="native", mode="covering")
