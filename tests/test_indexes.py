"""Stored indexes against plain scans: trigram search, pivot search, key filters, deep pages, statistics by month,
reused vectors, pages of files."""

import datetime as dt
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.operators import pivots as PV
from docweave.operators import records as RC
from docweave.operators import search as SR
from docweave.operators import trigrams as TG
from docweave.operators import validate as VD
from docweave.operators import vectors as VC
from docweave.sources import key_filters as KF
from docweave.sources import statistics as ST
from docweave.sources import tables as TB

TXT = "file_id string, upload_datetime timestamp_ntz, title string, content string, source_file string, source_link string, file_size long, version int, content_hash string"


def txt_rows(spark, rows):
    """Rows of the TXT table from (name, content, upload time)."""
    import hashlib

    out = [
        (f"txt_{name}", when, name, text, name, None, len(text or ""), 1, hashlib.md5((text or "").encode()).hexdigest())
        for name, text, when in rows
    ]
    return spark.createDataFrame(out, TXT)


def month(k):
    return dt.datetime(2024, k, 5, 12)


# -- Q1 by trigrams -------------------------------------------------------------------------------

PATTERNS = [
    "needle", "NEEDLE", "need(le|ful)", "(alpha|beta) gamma", "colou?r", "a.c", "x{3}", "xyz{2,}", "(?:one|two|three) fish", "^start", "end$",
    r"\bword\b", "tiếng việt", "stra(ß|ss)e", "K12", "[Kk]elvin", "(abc)+d", "(abc)*def", "(?=look)look ahead", "no such thing", "", ".", r"\d{3}-\d{4}",
    "ISTANBUL", "miss(?!ing)", "(?P<q>['\"])quoted(?P=q)", "a|needle",
]


@pytest.fixture(scope="module")
def searched(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    rng = random.Random(3)
    texts = [" ".join(rng.choice("lorem ipsum dolor sit amet colour fish word".split()) for _ in range(30)) for _ in range(60)]
    texts += ["A Needle here", "needful things", "alpha gamma", "BETA GAMMA", "color", "abc", "xxx", "xyzz", "two fish", "start here\nnow", "at the end"]
    texts += ["Tiếng Việt", "TIẾNG VIỆT", "Straße", "STRASSE", "K12", "Kelvin", "abcabcd", "def", "look ahead", "555-1234", "ıstanbul", "İstanbul"]
    texts += ["iſtanbul", "missing", "missed", "'quoted'", '"quoted\'', "", None, "ab", "end\n", "x" * 100_000 + "needle"]
    rows = [(f"f{i}.txt", t, month(1 + i % 5)) for i, t in enumerate(texts)]
    held = txt_rows(spark, rows).withColumn("content", F.col("content"))
    TB.append_documents(held.where("file_id <> 'txt_f3.txt'"), root, S.TXT_TABLE)
    assert TG.update_index(spark, root, S.TXT_TABLE) > 0 and TG.update_index(spark, root, S.TXT_TABLE) == 0
    return root


@pytest.mark.parametrize("pattern", PATTERNS)
def test_indexed_search_equals_the_scan(spark, searched, pattern):
    scan = SR.search_documents({S.TXT_TABLE: TB.read_table(spark, searched, S.TXT_TABLE)}, pattern, 1000)
    index = TG.search_indexed(spark, searched, pattern, 1000, [S.TXT_TABLE])
    got = [r.source_file for r in index.collect()]
    assert got == [r.source_file for r in scan.collect()]
    assert sorted(index.columns) == sorted(scan.columns)


def test_required_trigrams():
    need = TG.required_trigrams
    assert need("Needle") == [frozenset({"nee", "eed", "edl", "dle"})]
    assert need("(abcd|xyz)") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]
    assert need("abc.*xyz") == [frozenset({"abc", "xyz"})]
    for nothing in ("", "ab", "a|needle", "(needle)?", "(needle)*", r"\p{L}needle", "(?x) n e e d l e", "né", "[abc]def?"):
        assert need(nothing) == [frozenset()], nothing
    assert need("(needle)+") == need("needle")
    long = "|".join(f"{k:02d}word" for k in range(40))
    assert need(f"({long})") == [frozenset()] and need(f"prefix({long})") == need("prefix")


def test_folding_covers_every_character_that_matches_a_letter(spark):
    """Java's case-insensitive match of ASCII letters, over all characters."""
    java = spark._jvm.java.util.regex.Pattern
    letters = java.compile("(?iu)[a-z]")
    odd = "".join(chr(c) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000)
    matcher = letters.matcher(odd)
    found = ""
    while matcher.find():
        found += matcher.group()
    assert sorted(found) == sorted(set(TG.FOLD_FROM) & set(found)) and "ſ" in found


def test_a_rare_word_opens_few_files_and_late_files_are_scanned(spark, tmpdir_path):
    root = tmpdir_path
    rows = [(f"m{k}-{i}.txt", f"text number {i} of month {k} " + ("rareword" if (k, i) == (7, 3) else "common words"), month(k)) for k in range(1, 10) for i in range(20)]
    TB.append_documents(txt_rows(spark, rows), root, S.TXT_TABLE)
    TG.update_index(spark, root, S.TXT_TABLE)
    total = TB.files_of(spark, root, S.TXT_TABLE).count()
    hits, files = TG.candidate_rows(spark, root, S.TXT_TABLE, "rareword")
    assert total >= 9 and len(files) == 1 and "2024-07" in files[0] and [r.source_file for r in hits.collect()] == ["m7-3.txt"]
    assert TG.candidate_rows(spark, root, S.TXT_TABLE, "neverseen")[1] == []
    assert len(TG.candidate_rows(spark, root, S.TXT_TABLE, "common")[1]) >= 9
    assert len(TG.candidate_rows(spark, root, S.TXT_TABLE, "r.r")[1]) == total
    TB.append_documents(txt_rows(spark, [("late.txt", "a RareWord too", month(11))]), root, S.TXT_TABLE)
    got = TG.search_indexed(spark, root, "rareword", 10, [S.TXT_TABLE]).collect()
    assert [r.source_file for r in got] == ["m7-3.txt", "late.txt"]
    assert TG.update_index(spark, root, S.TXT_TABLE) == 1
    assert [r.source_file for r in TG.search_indexed(spark, root, "rareword", 10, [S.TXT_TABLE]).collect()] == ["m7-3.txt", "late.txt"]


# -- Q3 by pivots ---------------------------------------------------------------------------------


def test_pivot_search_equals_brute_force_and_scores_a_part(spark, tmpdir_path):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(30, 16))
    vectors = (centers[rng.integers(30, size=3000)] + rng.normal(size=(3000, 16)) * 0.15).astype(np.float32)
    rows = [(f"p{i:04d}", v.tolist(), i % 3) for i, v in enumerate(vectors)]
    rows += [(f"q{i}", vectors[5].tolist(), 1) for i in range(40)]  # ties
    rows += [("none", None, 0), ("zero", [0.0] * 16, 0), ("short", [1.0, 2.0], 0), ("back", (-vectors[5]).tolist(), 0), ("long", (vectors[5] * 1000).tolist(), 2)]
    pts = spark.createDataFrame(rows, "point_id string, embedding array<float>, label int")
    PV.build_index(pts, tmpdir_path + "/index")
    index = PV.PivotIndex(spark, tmpdir_path + "/index")
    pts = pts.cache()
    share = []
    for query, kw in [
        (vectors[5].tolist(), {}),
        (vectors[77].tolist(), {"limit": 25, "score_threshold": 0.5}),
        (vectors[8].tolist(), {"filter_conditions": {"label": 2}}),
        (rng.normal(size=16).tolist(), {"score_threshold": -1.0}),
        ((vectors[9] * 0).tolist(), {}),
        ([1.0, 2.0], {"limit": 3}),
        (vectors[5].tolist(), {"limit": 0}),
        (vectors[5].tolist(), {"filter_conditions": {"label": 99}}),
        (vectors[12].tolist(), {"limit": 5000, "score_threshold": -1.0}),
    ]:
        want = [(r.point_id, round(r.score, 9)) for r in VC.vector_search(pts, query, **kw).collect()]
        got = index.search(query, **kw)
        assert [(r.point_id, round(r.score, 9)) for r in got.collect()] == want
        if not kw:
            n = index.candidates(query, 10, 0.0, None, "embedding", "point_id").count()
            share.append(n / len(rows))
    assert share[0] < 0.15  # of the points, scored after the first look
    empty = tmpdir_path + "/empty"
    PV.build_index(pts.limit(0), empty)
    assert PV.PivotIndex(spark, empty).search(vectors[5].tolist()).count() == 0


# -- W2/W3/K13 by key filters ---------------------------------------------------------------------


def test_months_without_a_key_are_not_read(spark, tmpdir_path):
    root = tmpdir_path
    rows = [(f"m{k}-{i}.txt", f"content {k} {i}", month(k)) for k in range(1, 10) for i in range(50)]
    TB.append_documents(txt_rows(spark, rows), root, S.TXT_TABLE)
    names = spark.createDataFrame([("m3-7.txt",), ("m5-1.txt",), ("absent.txt",), (None,)], "source_file string")
    months = TB.touched_months(spark, root, S.TXT_TABLE, "name", names)
    assert {"2024-03", "2024-05"} <= set(months) and len(months) <= 4
    plan = TB.rows_of_months(spark, root, S.TXT_TABLE, ["2024-03"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*upload_month", plan)
    # the same bytes and name again in another month: nothing; new bytes under an old name: the next version
    again = txt_rows(spark, [("m3-7.txt", "content 3 7", month(11)), ("m5-1.txt", "changed", month(11)), ("new.txt", "content 9 9", month(11))])
    out = {(r.source_file, r.version) for r in TB.append_documents(again, root, S.TXT_TABLE).collect()}
    assert out == {("m5-1.txt", 2), ("new.txt", 1)}
    # by content
    up = spark.createDataFrame([("x.txt", "txt", bytearray(b"content 4 4")), ("y.txt", "txt", bytearray(b"unseen")), ("z.pdf", "pdf", bytearray(b"content 4 4"))], "filename string, file_type string, content binary")
    held = TB.content_conflicts(spark, root, S.TXT_TABLE, VD.content_hashes(up))
    listing = spark.createDataFrame([], "name string")
    got = {r.filename: (r.status_code, r.detail) for r in VD.upload_gate(up, listing, stored=held).collect()}
    assert got["x.txt"] == (409, "Content of 'x.txt' is already stored as 'm4-4.txt'")
    assert got["y.txt"][0] == got["z.pdf"][0] == 201
    assert TB.content_conflicts(spark, root + "/nothing", S.TXT_TABLE, VD.content_hashes(up)).count() == 0
    assert TB.list_tables(spark, root) == ["txt_documents"]


def test_filters_have_no_false_negative_and_few_false_positives(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(KF, "BLOCKS", 64)
    keys = spark.range(600).select(F.concat(F.lit("k"), "id").alias("source_file"), F.md5(F.col("id").cast("string")).alias("content_hash"))
    keys = keys.withColumn("month", F.concat(F.lit("2024-0"), (F.crc32("source_file") % 3).cast("string")))
    table = tmpdir_path + "/t"
    KF.add(keys.where("month <> '2024-01'"), table, "month")
    KF.add(keys.where("month = '2024-01'"), table, "month")
    for k in (0, 17, 599):
        own = keys.where(F.col("source_file") == f"k{k}")
        assert own.first()["month"] in KF.months(spark, table, "name", own.select("source_file"))
        assert own.first()["month"] in KF.months(spark, table, "hash", own.select("content_hash"))
    false = [len(KF.months(spark, table, "name", spark.createDataFrame([(f"absent{k}",)], "source_file string"))) for k in range(8)]
    assert sum(false) <= 3


# -- S8 -------------------------------------------------------------------------------------------


def test_deep_pages(spark, deep=7):
    rng = random.Random(2)
    times = [None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 3, 3)]
    ids = [None, "", "a", "a\x00", "ab", "é", "日本", "same-long-prefix-of-ids-0001", "same-long-prefix-of-ids-0002"]
    rows = [(rng.choice(times), rng.choice(ids), f"s{i:04d}" if i % 9 else None, i) for i in range(700)]
    rows += [(dt.datetime(2024, 1, 1), "same-long-prefix-of-ids-0001", f"t{i:04d}", 1000 + i) for i in range(300)]  # a hot time and id
    df = spark.createDataFrame(rows, "upload_datetime timestamp_ntz, file_id string, source_file string, n int").cache()
    key = ["upload_datetime", "file_id", "source_file"]
    want = [(r.upload_datetime, r.file_id, r.source_file) for r in df.orderBy(*key).collect()]
    for offset in (61, 333, 640, 999, 5000):
        got = [(r.upload_datetime, r.file_id, r.source_file) for r in TB.table_page(df, limit=15, offset=offset, deep=deep).collect()]
        assert got == want[offset : offset + 15], offset
    assert [(r.upload_datetime, r.file_id, r.source_file) for r in TB.table_page(df.where("source_file is not null"), offset=700, deep=deep).collect()] == [
        w for w in want if w[2] is not None
    ][700:]
    assert TB.table_page(df.limit(0), limit=5, offset=100, deep=deep).count() == 0


# -- A1 -------------------------------------------------------------------------------------------


def test_statistics_recount_only_touched_months(spark, tmpdir_path):
    root = tmpdir_path
    TB.append_documents(txt_rows(spark, [(f"m{k}-{i}.txt", f"text {k} {i}", month(k)) for k in range(1, 7) for i in range(20)]), root, S.TXT_TABLE)
    assert len(ST.refresh_statistics(spark, root, S.TXT_TABLE)) == 6
    assert ST.refresh_statistics(spark, root, S.TXT_TABLE) == []
    again = [("m2-1.txt", "other bytes", month(2)), ("m2-2.txt", "text 2 2", month(2)), ("m9.txt", "é", month(9))]
    TB.append_documents(txt_rows(spark, again), root, S.TXT_TABLE)
    assert ST.stale_months(spark, root, S.TXT_TABLE) == ["2024-02", "2024-09"]
    got = ST.stored_statistics(spark, root, S.TXT_TABLE)
    whole = TB.table_statistics(TB.read_table(spark, root, S.TXT_TABLE).drop("upload_month"), S.TXT_TABLE)
    assert sorted(map(tuple, got.drop("distinct_estimate").collect())) == sorted(map(tuple, whole.collect()))
    names = got.where("column_name = 'source_file'").first()
    assert names["row_count"] == 122 and abs(names["distinct_estimate"] - 121) <= 4


# -- T3 -------------------------------------------------------------------------------------------


def test_no_text_is_embedded_twice(spark, tmpdir_path):
    log, store = os.path.join(tmpdir_path, "calls"), os.path.join(tmpdir_path, "vectors")
    os.makedirs(log)

    def embedder(texts):
        import uuid

        with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
            f.write(f"{time.time()}\n" + "\n".join(texts))
        if "poison" in texts:
            raise ValueError("refused")
        return VC.md5_embedder(texts)

    texts = [f"text {i % 40}" for i in range(200)] + ["hot"] * 300 + ["poison", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, chunk_text string").repartition(7)
    run = lambda rows, **kw: {r.i: r.embedding for r in VC.embed_reusing(rows, embedder, store, "md5", **kw).collect()}
    got = run(df, batch_size=8)
    asked = [t for name in os.listdir(log) for t in open(os.path.join(log, name)).read().split("\n")[1:]]
    assert sorted(t for t in set(asked) if asked.count(t) > 1) in ([], ["poison"]) or "poison" in asked  # retried one by one beside it
    for i, t in enumerate(texts):
        assert got[i] == (None if t == "poison" else VC.md5_embedder([t or ""])[0])
    before = len(os.listdir(log))
    assert run(df.where("chunk_text <> 'poison' or chunk_text is null")) == {i: v for i, v in got.items() if texts[i] != "poison"}
    assert len(os.listdir(log)) == before  # the second run calls the model 0 times
    other = VC.embed_reusing(df.where("chunk_text = 'hot'"), lambda ts: [[1.0]] * len(ts), store, "another model").collect()
    assert {tuple(r.embedding) for r in other} == {(1.0,)} and len(other) == 300
    # a shared rate: 30 calls of one text, by 3 tasks, at 20 a second
    fresh = spark.createDataFrame([(i, f"fresh {i}") for i in range(30)], "i int, chunk_text string")
    run(fresh, batch_size=1, calls_per_second=20, tasks=3)
    times = sorted(float(open(os.path.join(log, n)).readline()) for n in os.listdir(log))[before:]
    assert len(times) == 30 and (30 - 3) / (times[-1] - times[0]) <= 20  # beyond the first call of each task


# -- T9 -------------------------------------------------------------------------------------------


def test_pages_of_files(spark):
    def paginate(data):
        if data.startswith(b"broken"):
            raise OSError("no file of pages")
        return data.split(b"\f") if data else []

    def read_page(page):
        if b"bad" in page:
            raise ValueError("bad page")
        return page.decode() if page != b"image" else None

    files = [("a", b"one\ftwo\f\fbad\fimage\flast"), ("b", b"broken"), ("c", b""), ("d", b"bad\fbad"), ("e", b"\f".join(b"p%d" % i for i in range(2500)))]
    df = spark.createDataFrame([(n, bytearray(d), "kept") for n, d in files], "name string, content binary, page string")
    pages = RC.extract_pages(df, paginate, read_page)
    assert pages.columns == ["name", "page", "page_no", "page_text", "page_error"]
    got = {r.name: tuple(r)[1:] for r in RC.join_pages(pages, "name").collect()}
    assert got["a"] == ("one\n\ntwo\n\nlast", 6, 1, None)
    assert got["b"] == ("", 0, 0, "OSError: no file of pages")
    assert got["c"] == ("", 0, 0, None)
    assert got["d"] == ("", 2, 2, "ValueError: bad page")
    assert got["e"] == ("\n\n".join(f"p{i}" for i in range(2500)), 2500, 0, None)


# -- Q2 -------------------------------------------------------------------------------------------


def test_lookup_broadcasts_the_winners_and_shuffles_no_content(spark):
    docs = spark.range(200).select(
        F.concat(F.lit("id"), (F.col("id") % 50).cast("string")).alias("file_id"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("upload_datetime"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("f"), "id")).alias("source_file"), F.repeat(F.lit("x"), 1000).alias("content"),
    )
    asked = spark.createDataFrame([("id7",), ("id7",), ("gone",), (None,)], "file_id string")
    out = SR.documents_by_ids({"a": docs.where("source_file <> 'f7'"), "b": docs}, asked)
    rows = sorted(map(tuple, out.select("file_id", "source_file", "source_table").collect()), key=str)
    assert rows == [("gone", None, None), ("id7", "f107", "a"), (None, None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
