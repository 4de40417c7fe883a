import math
import pytest
from pyspark.sql import functions as F

from docweave.operators import search as SR
from docweave.operators import validate as VD
from docweave.operators import vectors as VC
from docweave.sources import tables as TB


def test_file_size_rule(spark):
    limit = 50 * 1024 * 1024
    df = spark.createDataFrame([(0,), (limit,), (limit + 1,)], "n long")
    r = VD.file_size_rule(F.col("n"), F.lit("f.txt"))
    got = [tuple(x) for x in df.select(r["status_code"], r["detail"]).collect()]
    assert got == [(400, "File is empty"), (None, None), (413, "File f.txt has size exceeds 50MB limit")]


def test_filename_rule(spark):
    names = [""] + [f"a{c}b.pdf" for c in '<>:"|?*\\/'] + ["a" * 251 + ".pdf", "a" * 252 + ".pdf", "doc.txt", "DOC.PDF"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(VD.filename_rule(F.col("n"), "pdf")["detail"]).collect()]
    assert got == (
        ["Filename cannot be empty"]
        + ["Filename contains invalid characters: ['<', '>', ':', '\"', '|', '?', '*', '\\\\', '/']"] * 9
        + [None, "Filename too long (maximum 255 characters)", "Filename must end with .pdf", None]
    )


def test_upload_gate_partition(spark):
    cands = spark.createDataFrame(
        [("a.txt", "txt", bytearray(b"hello")), ("b.docx", "txt", bytearray(b"x")), ("c.txt", "txt", bytearray(b"")),
         ("d.txt", "txt", bytearray(b"  \n ")), ("e.pdf", "pdf", bytearray(b"%PDF")), ("f.txt", "txt", bytearray(b"x" * 20))],
        "filename string, file_type string, content binary",
    )
    listing = spark.createDataFrame([("pdfs/e.pdf",)], "name string")
    out = {r.filename: (r.status_code, r.detail, r.upload_path) for r in VD.upload_gate(cands, listing, max_mb=10 / (1024 * 1024)).collect()}
    assert out["a.txt"] == (201, "TXT file uploaded successfully", "txts/a.txt")
    assert out["b.docx"] == (400, "Only TXT files are allowed", None)
    assert out["c.txt"] == (400, "File is empty", None)
    assert out["d.txt"] == (400, "Text file is empty or contains only whitespace", None)
    assert out["e.pdf"] == (409, "File 'e.pdf' already exists", None)
    assert out["f.txt"][0] == 413
    assert len(out) == 6  # accepted and rejected partition the candidates


def _tables(spark):
    pdf = spark.createDataFrame(
        [("p1", "2024-01-01 00:00:00", "silver/pdfs/Élan.md")], "file_id string, upload_datetime string, content string"
    ).withColumn("upload_datetime", F.col("upload_datetime").cast("timestamp_ntz"))
    txt = spark.createDataFrame(
        [("t1", "2024-01-02 00:00:00", "an ÉLAN here"), ("t2", "2024-01-03 00:00:00", None), ("t3", "2024-01-01 00:00:00", "plain")],
        "file_id string, upload_datetime string, content string",
    ).withColumn("upload_datetime", F.col("upload_datetime").cast("timestamp_ntz"))
    return {"pdf_documents": pdf, "txt_documents": txt}


def test_null_keys_are_found(spark):
    rows = [(None, "2024-01-01 00:00:00", "silver/pdfs/a.md"), ("p2", "2024-01-01 00:00:00", "silver/pdfs/b.md"), (None, None, "silver/c.md")]
    pdf = spark.createDataFrame(rows, "file_id string, upload_datetime string, content string")
    pdf = pdf.withColumn("upload_datetime", F.col("upload_datetime").cast("timestamp_ntz"))
    got = SR.search_documents({"pdf_documents": pdf}, "silver", limit=3).collect()
    assert [r.content for r in got] == ["silver/c.md", "silver/pdfs/a.md", "silver/pdfs/b.md"]
    assert [r.content for r in TB.table_page(pdf, limit=2).collect()] == ["silver/c.md", "silver/pdfs/a.md"]
    assert [r.content for r in TB.page_after(pdf, None, 2).collect()] == ["silver/c.md", "silver/pdfs/a.md"]
    last = got[1]
    assert [r.content for r in TB.page_after(pdf, (last.upload_datetime, None), 2).collect()] == ["silver/pdfs/b.md"]
    assert [r.content for r in TB.page_after(pdf, (None, None), 2).collect()] == ["silver/pdfs/a.md", "silver/pdfs/b.md"]


def test_search_documents(spark):
    t = _tables(spark)
    got = [(r.source_table, r.file_id) for r in SR.search_documents(t, "élan").collect()]
    assert got == [("pdf_documents", "p1"), ("txt_documents", "t1")]  # accented, case-insensitive; null never matches
    assert SR.search_documents(t, "").count() == 3  # empty query matches every non-null content
    assert SR.search_documents(t, "élan", limit=0).count() == 0
    with pytest.raises(ValueError):
        SR.search_documents(t, "(unclosed")
    with pytest.raises(ValueError):
        SR.search_documents(t, "x", limit=-1)


def test_document_lookup(spark):
    t = _tables(spark)
    assert [r.source_table for r in SR.document_by_id(t, "t1").collect()] == ["txt_documents"]
    assert SR.document_by_id(t, "nope").count() == 0
    req = spark.createDataFrame([("t1",), ("nope",)], "file_id string")
    got = {r.file_id: r.source_table for r in SR.documents_by_ids(t, req).collect()}
    assert got == {"t1": "txt_documents", "nope": None}


def test_search_is_unicode_and_takes_named_groups(spark):
    t = _tables(spark)
    txt = t["txt_documents"].withColumn("content", F.lit("le réseau ÉLAN élan"))
    assert SR.search_documents({"txt_documents": txt}, r"r\wseau").count() == 3
    assert SR.search_documents({"txt_documents": txt}, r"(?P<w>élan) (?P=w)").count() == 3


def test_contents_stay_out_of_the_sorts_and_gates(spark):
    """Only keys are ordered, aggregated or joined against the listing; contents are fetched at the end."""
    from docweave import fixtures as FX

    sf = "/root/testdata/sf0.001"
    tables = {"pdf_documents": FX.pdf_documents(spark, sf), "txt_documents": FX.txt_documents(spark, sf)}
    plan = SR.documents_by_ids(tables, tables["txt_documents"])._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate" in line]
    assert grouped and not any("content#" in line for line in grouped)
    gate = VD.upload_gate(FX.upload_candidates(spark, sf), spark.createDataFrame([("x",)], "name string"))
    text = gate._jdf.queryExecution().executedPlan().toString()
    joined = text[: text.index("Join")] if "Join" in text else text
    assert "content#" not in joined and "Python" not in text


def test_txt_rules(spark):
    df = spark.createDataFrame([(bytearray(b" short "),), (bytearray(b"long enough"),), (bytearray(b""),)], "c binary")
    r = VD.txt_content_rule(F.col("c"), min_length=8)["detail"]
    assert [x[0] for x in df.select(r).collect()] == [
        "Text content too short (minimum 8 characters)", None, "Text file is empty or contains only whitespace"]
    old = VD.txt_size_rule_legacy(F.octet_length("c"), max_mb=8 / 1024 / 1024)
    assert [x[0] for x in df.select(old["ok"]).collect()] == [True, False, True]


def _points(spark):
    rows = [
        ("a", [1.0, 0.0], 0), ("b", [0.0, 1.0], 1), ("c", [1.0, 1.0], 0), ("d", [0.0, 0.0], 1),
        ("e", None, 0), ("f", [2.0, 0.0], 1), ("g", [1.0, 0.0, 0.0], 0),
    ]
    return spark.createDataFrame(rows, "point_id string, embedding array<float>, label int")


def test_vector_search_edges(spark):
    pts = _points(spark)
    got = [(r.point_id, round(r.score, 6)) for r in VC.vector_search(pts, [1.0, 0.0], limit=10).collect()]
    # zero vector, null vector and wrong dimension score null and never match; ties by id
    assert got == [("a", 1.0), ("f", 1.0), ("c", 0.707107), ("b", 0.0)]
    got = [r.point_id for r in VC.vector_search(pts, [1.0, 0.0], limit=10, score_threshold=1 / math.sqrt(2)).collect()]
    assert got == ["a", "f", "c"]  # threshold is inclusive
    assert VC.vector_search(pts, [0.0, 0.0]).count() == 0  # zero query vector
    assert [r.point_id for r in VC.vector_search(pts, [1.0, 0.0], filter_conditions={"label": 1}).collect()] == ["f", "b"]


def test_vector_search_batch_matches_single(spark):
    pts = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("point_id"), "embedding", "vec_id"
    )
    queries = pts.where("vec_id < 9").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    one_pass = VC.vector_search_batch(pts, queries, k=5)
    many = VC.vector_search_batch(pts, queries, k=5, max_queries_per_pass=2)  # several broadcast passes
    a = sorted((r.query_id, r.point_id, round(r.score, 9)) for r in one_pass.collect())
    b = sorted((r.query_id, r.point_id, round(r.score, 9)) for r in many.collect())
    assert a == b and len(a) == 45
    q0 = [r.embedding for r in pts.where("vec_id = 0").collect()][0]
    single = [(r.point_id, round(r.score, 9)) for r in VC.vector_search(pts, q0, limit=5).collect()]
    assert [(p, s) for q, p, s in sorted(a, key=lambda x: (x[0], -x[2], x[1])) if q == 0] == single


def test_points_maintenance(spark):
    pts = _points(spark)
    new = spark.createDataFrame([("a", [0.5, 0.5], 9)], "point_id string, embedding array<float>, label int")
    up = {r.point_id: r.label for r in VC.upsert_points(pts, new).collect()}
    assert up["a"] == 9 and len(up) == 7
    kept = VC.delete_by_filter(pts, F.col("label") == 1)
    assert sorted(r.point_id for r in kept.collect()) == ["a", "c", "e", "g"]
    nulls = pts.withColumn("label", F.when(F.col("point_id") == "a", F.lit(None)).otherwise(F.col("label")))
    assert "a" in [r.point_id for r in VC.delete_by_filter(nulls, F.col("label") == 0).collect()]  # null predicate keeps
    info = VC.collection_info(pts).first()
    assert (info.points_count, info.vectors_count, info.vector_size) == (7, 6, 3)


def test_search_resolved_silver_text(spark):
    t = _tables(spark)
    silver = spark.createDataFrame([("silver/pdfs/Élan.md", "the extracted words: zebra")], "path string, text string")
    got = [(r.source_table, r.file_id) for r in SR.search_documents(t, "ZEBRA", silver=silver).collect()]
    assert got == [("pdf_documents", "p1")]
    assert SR.search_documents(t, "zebra").count() == 0  # the stored path does not contain it
