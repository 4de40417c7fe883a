"""Job tests on temporary folders: staged files -> file stream -> tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.operators import vectors as VC
from docweave.sources import tables as TB
from docweave.streaming import file_stream as FS


def _stage(root, rel, data: bytes):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def test_txt_stream_ingest_idempotent(spark, tmpdir_path):
    staging, wh, ckpt, arch = (os.path.join(tmpdir_path, x) for x in ("staging", "wh", "ckpt", "archive"))
    _stage(staging, "txts/a_note.txt", "hello world".encode("utf-8"))
    _stage(staging, "txts/b-latin.txt", "caf\xe9 au lait!".encode("latin-1"))
    _stage(staging, "txts/copy.txt", "hello world".encode("utf-8"))  # same content, another name
    FS.run_ingest(spark, staging, wh, ckpt, "txt", "2024-06-01 00:00:00", post="archive", archive_dir=arch)
    t = TB.read_table(spark, wh, S.TXT_TABLE)
    rows = {r.source_file: r for r in t.collect()}
    assert set(rows) == {"a_note.txt", "b-latin.txt", "copy.txt"}
    assert rows["a_note.txt"].title == "A Note"
    assert rows["a_note.txt"].content_hash == "5eb63bbbe01eeed093cb22bb8f5acdc3"
    assert rows["a_note.txt"].upload_month == "2024-06"
    # the latin-1 body has odd length, so it is not UTF-16 either: latin-1 decoding
    assert rows["b-latin.txt"].content == "café au lait!"
    # second run: only the new file is read; nothing is written twice
    _stage(staging, "txts/new.txt", b"new text here")
    FS.run_ingest(spark, staging, wh, ckpt, "txt", "2024-06-01 00:00:00", post="archive", archive_dir=arch)
    t = TB.read_table(spark, wh, S.TXT_TABLE)
    assert t.count() == 4
    assert t.select("file_id", "source_file").distinct().count() == 4
    status = spark.read.parquet(os.path.join(wh, "ingest_status"))
    assert status.where("status = 'completed'").count() == 4
    # completed files are archived by their own run
    archived = [f for _, _, fs in os.walk(arch) for f in fs if not f.startswith(".")]
    assert "a_note.txt" in archived


def test_pdf_batch_with_corrupt_file(spark, tmpdir_path):
    from docweave.plans import ingest as IN

    staging, wh = os.path.join(tmpdir_path, "staging"), os.path.join(tmpdir_path, "wh")
    _stage(staging, "pdfs/good.pdf", "Some extracted text.".encode("utf-8"))
    _stage(staging, "pdfs/bad.pdf", b"\xff\xfe\xfa broken")
    files = IN.read_staged(spark, staging, "pdf")
    status = {r.filename: r for r in IN.ingest_files(files, "pdf", wh, "2024-06-01 00:00:00").collect()}
    assert status["good.pdf"].status == "completed" and status["good.pdf"].file_id.startswith("pdf_")
    assert status["bad.pdf"].status == "failed" and status["bad.pdf"].file_id == ""
    assert status["bad.pdf"].message.startswith("Processing error: ")
    t = TB.read_table(spark, wh, S.PDF_TABLE)
    assert [r.source_file for r in t.collect()] == ["good.pdf"]
    r = t.first()
    assert r.content == "silver/pdfs/good.md" and r.page_count == 1 and r.version == 1
    silver = spark.read.parquet(os.path.join(wh, "silver_documents"))
    assert [(x.path, x.text) for x in silver.collect()] == [("silver/pdfs/good.md", "Some extracted text.")]
    IN.ingest_files(files, "pdf", wh, "2024-07-01 00:00:00")  # a later run of the same files: nothing twice
    assert spark.read.parquet(os.path.join(wh, "silver_documents")).count() == 1
    assert TB.read_table(spark, wh, S.PDF_TABLE).count() == 1
    bad = spark.read.parquet(os.path.join(wh, "quarantine")).where("run_ts = '2024-06-01 00:00:00'").collect()
    assert [(r.object_name, bytes(r.content)) for r in bad] == [("pdfs/bad.pdf", b"\xff\xfe\xfa broken")]


def test_failed_and_empty_files_are_kept(spark, tmpdir_path):
    """Under delete only completed files go; every staged file has a status row."""
    staging, wh, ckpt = (os.path.join(tmpdir_path, x) for x in ("staging", "wh", "ckpt"))
    _stage(staging, "pdfs/good.pdf", b"Good text.")
    _stage(staging, "pdfs/bad.pdf", b"\xff\xfe\xfa broken")
    _stage(staging, "pdfs/empty.pdf", b"")
    _stage(staging, "pdfs/deep/poor summary.pdf", b"No summary for this one.")

    def summarizer(text):
        if "No summary" in text:
            raise ValueError("model failed")
        return "Summary of " + text

    collection = os.path.join(tmpdir_path, "points")
    job = dict(summarizer=summarizer, embedder=VC.md5_embedder, collection=collection, max_files_per_trigger=2)
    FS.run_ingest(spark, staging, wh, ckpt, "pdf", "2024-06-01 00:00:00", post="delete", **job)
    left = sorted(f for _, _, fs in os.walk(staging) for f in fs if not f.startswith("."))
    assert left == ["bad.pdf", "empty.pdf"]
    status = {r.object_name: (r.status, r.vectorized) for r in spark.read.parquet(os.path.join(wh, "ingest_status")).collect()}
    assert status == {
        "pdfs/good.pdf": ("completed", True),
        "pdfs/deep/poor summary.pdf": ("completed", False),
        "pdfs/bad.pdf": ("failed", False),
        "pdfs/empty.pdf": ("failed", None),
    }
    points = VC.read_points(spark, collection).collect()
    assert [(p.source, p.kind, p.text) for p in points] == [("silver/pdfs/good.md", "summary", "Summary of Good text.")]


def _status(spark, wh):
    return sorted((r.object_name, r.status) for r in FS.read_status(spark, wh).collect())


def test_every_failed_file_of_a_run_is_kept(spark, tmpdir_path):
    """One file a micro-batch: no batch overwrites another's quarantine or status rows."""
    staging, wh, ckpt = (os.path.join(tmpdir_path, x) for x in ("staging", "wh", "ckpt"))
    _stage(staging, "pdfs/good.pdf", b"Good text.")
    for k in range(3):
        _stage(staging, f"pdfs/bad{k}.pdf", b"\xff\xfe\xfa broken %d" % k)
    FS.run_ingest(spark, staging, wh, ckpt, "pdf", "2024-06-01 00:00:00", max_files_per_trigger=1)
    bad = [(f"pdfs/bad{k}.pdf", "failed") for k in range(3)]
    assert _status(spark, wh) == [*bad, ("pdfs/good.pdf", "completed")]
    kept = {r.object_name: bytes(r.content) for r in spark.read.parquet(os.path.join(wh, "quarantine")).collect()}
    assert kept == {f"pdfs/bad{k}.pdf": b"\xff\xfe\xfa broken %d" % k for k in range(3)}
    # another checkpoint knows nothing of the first: it processes all again and keeps the earlier rows
    FS.run_ingest(spark, staging, wh, ckpt + "2", "pdf", "2024-06-02 00:00:00", max_files_per_trigger=1)
    assert len(_status(spark, wh)) == 8
    assert spark.read.parquet(os.path.join(wh, "quarantine")).count() == 6
    assert TB.read_table(spark, wh, S.PDF_TABLE).count() == 1
    # failed files are tried again by each run of a checkpoint, completed ones are not
    FS.run_ingest(spark, staging, wh, ckpt, "pdf", "2024-06-03 00:00:00")
    assert len(_status(spark, wh)) == 11
    assert sorted(r.status for r in FS.current_status(FS.read_status(spark, wh)).collect()) == ["completed"] + ["failed"] * 3


def test_changed_and_refilled_files_are_ingested_by_the_same_checkpoint(spark, tmpdir_path):
    staging, wh, ckpt, arch = (os.path.join(tmpdir_path, x) for x in ("staging", "wh", "ckpt", "archive"))
    _stage(staging, "txts/a.txt", b"first version")
    _stage(staging, "txts/e.txt", b"")
    _stage(staging, "txts/keep [1] {x}*+%20 \xc3\xa9.txt", b"an odd name")
    run = lambda ts, **kw: FS.run_ingest(spark, staging, wh, ckpt, "txt", ts, **kw)
    run("2024-06-01 00:00:00")
    odd = "txts/keep [1] {x}*+%20 \xc3\xa9.txt"
    assert _status(spark, wh) == [("txts/a.txt", "completed"), ("txts/e.txt", "failed"), (odd, "completed")]
    run("2024-06-02 00:00:00", post="archive", archive_dir=arch)  # only the empty file is tried again
    assert len(_status(spark, wh)) == 4 and not os.path.exists(arch)
    _stage(staging, "txts/a.txt", b"second, longer version")
    _stage(staging, "txts/e.txt", b"now it has text")
    run("2024-06-03 00:00:00", post="archive", archive_dir=arch)
    rows = {(r.source_file, r.version): r.content for r in TB.read_table(spark, wh, S.TXT_TABLE).collect()}
    assert rows == {
        ("a.txt", 1): "first version",
        ("a.txt", 2): "second, longer version",
        ("e.txt", 1): "now it has text",
        (odd[5:], 1): "an odd name",
    }
    now = {r.object_name: r.status for r in FS.current_status(FS.read_status(spark, wh)).collect()}
    assert set(now.values()) == {"completed"}
    assert sorted(os.listdir(os.path.join(arch, "txts")))[:2] == ["a.txt", "e.txt"]
    run("2024-06-04 00:00:00")
    assert len(_status(spark, wh)) == 6  # nothing new, nothing done


def test_an_interrupted_batch_is_finished_by_the_next_run(spark, tmpdir_path, monkeypatch):
    staging, wh, ckpt = (os.path.join(tmpdir_path, x) for x in ("staging", "wh", "ckpt"))
    for k in range(3):
        _stage(staging, f"txts/f{k}.txt", b"file number %d" % k)
    import pytest

    def broken(*args):
        raise RuntimeError("the driver went away")

    monkeypatch.setattr(FS, "post_process", broken)  # after the batch's rows, statuses and ledger are written
    with pytest.raises(Exception, match="went away"):
        FS.run_ingest(spark, staging, wh, ckpt, "txt", "2024-06-01 00:00:00", post="delete", max_files_per_trigger=2)
    monkeypatch.undo()
    _stage(staging, "txts/f0.txt", b"changed before it was taken away")
    FS.run_ingest(spark, staging, wh, ckpt, "txt", "2024-06-02 00:00:00", post="delete", max_files_per_trigger=2)
    assert not [f for f in os.listdir(os.path.join(staging, "txts")) if f.endswith(".txt")]
    got = sorted((r.source_file, r.version) for r in TB.read_table(spark, wh, S.TXT_TABLE).collect())
    assert got in ([("f0.txt", 1), ("f0.txt", 2), ("f1.txt", 1), ("f2.txt", 1)], [("f0.txt", 1), ("f1.txt", 1), ("f2.txt", 1)])
    assert {s for _, s in _status(spark, wh)} == {"completed"}


def test_new_bytes_under_an_old_name(spark, tmpdir_path):
    from docweave.plans import ingest as IN

    wh = os.path.join(tmpdir_path, "wh")
    files = lambda data: spark.createDataFrame([("pdfs/a.pdf", bytearray(data))], "object_name string, content binary")
    for data, ts in ((b"first", "2024-06-01 00:00:00"), (b"second", "2024-06-02 00:00:00"), (b"second", "2024-07-02 00:00:00")):
        IN.ingest_files(files(data), "pdf", wh, ts)
    rows = TB.read_table(spark, wh, S.PDF_TABLE).orderBy("version").collect()
    assert [r.version for r in rows] == [1, 2]
    silver = spark.read.parquet(os.path.join(wh, "silver_documents")).collect()
    assert [(r.path, r.text) for r in silver] == [("silver/pdfs/a.md", "second")]


def test_ids_do_not_depend_on_the_session_zone(spark):
    from docweave.operators import records as RC

    files = spark.createDataFrame([("a.txt", bytearray(b"x"))], "filename string, content binary")
    files = files.withColumn("upload_datetime", F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    ids = set()
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            ids.add(RC.txt_records(files).first().file_id)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert ids == {"txt_2d711642b726b044_1710037800"}


def test_embedder_failure_costs_one_text(spark):
    def embedder(texts):
        if "poison" in texts:
            raise ValueError("refused")
        return VC.md5_embedder(texts)

    df = spark.createDataFrame([(i, "poison" if i == 7 else f"text {i}") for i in range(20)], "i int, chunk_text string").coalesce(1)
    got = {r.i: r.embedding for r in VC.embed_chunks(df, embedder).collect()}
    assert [i for i, v in got.items() if v is None] == [7]


def test_tables_and_paging(spark, tmpdir_path):
    wh = os.path.join(tmpdir_path, "wh")
    TB.ensure_tables(spark, wh)
    assert TB.list_tables(spark, wh) == ["pdf_documents", "txt_documents"]
    assert TB.table_exists(spark, wh, "txt_documents") and not TB.table_exists(spark, wh, "nope")
    t = TB.read_table(spark, wh, S.TXT_TABLE)
    assert t.count() == 0
    df = spark.range(25).select(
        F.format_string("id%02d", "id").alias("file_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("upload_datetime")
    )
    page = [r.file_id for r in TB.table_page(df, limit=5, offset=10).collect()]
    assert page == [f"id{i:02d}" for i in range(10, 15)]
    assert [r.file_id for r in TB.table_page(df, offset=22).collect()] == ["id22", "id23", "id24"]
    nxt = [r.file_id for r in TB.page_after(df, (dt.datetime(2024, 1, 1), page[-1]), 3).collect()]
    assert nxt == ["id15", "id16", "id17"]
    c = TB.page_counts(df, limit=5, offset=23).first()
    assert (c.total_rows, c.returned_rows) == (25, 2)


def test_listing_of_a_relative_root(spark, tmpdir_path, monkeypatch):
    from docweave.sources import listing as LS

    # the JVM's working directory is not Python's: a relative root is resolved where Spark resolves it
    here = spark._jvm.java.lang.System.getProperty("user.dir")
    rel = os.path.relpath(os.path.join(tmpdir_path, "staging"), here)
    _stage(os.path.join(tmpdir_path, "staging"), "txts/staging/a b+c%41.txt", b"x")
    _stage(os.path.join(tmpdir_path, "staging"), "txts/e.txt", b"")
    for root in (rel, os.path.join(tmpdir_path, "staging"), "file://" + os.path.join(tmpdir_path, "staging")):
        rows = {(r.name, r.size) for r in LS.list_objects(spark, root).collect()}
        assert rows == {("txts/staging/a b+c%41.txt", 1), ("txts/e.txt", 0)}
    assert LS.list_objects(spark, os.path.join(tmpdir_path, "nothing")).count() == 0


def test_points_collection_roundtrip(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "points")
    a = spark.createDataFrame([("p1", [1.0, 0.0], "x"), ("p2", [0.0, 1.0], "y")], "point_id string, embedding array<float>, text string")
    VC.save_points(a, path, dim=2)
    b = spark.createDataFrame([("p2", [1.0, 1.0], "y2"), ("p3", [0.5, 0.5], "z")], "point_id string, embedding array<float>, text string")
    VC.save_points(b, path, dim=2)
    got = {r.point_id: r.text for r in VC.read_points(spark, path).collect()}
    assert got == {"p1": "x", "p2": "y2", "p3": "z"}
    bad = spark.createDataFrame([("p9", [1.0, 0.0, 0.0], "w")], "point_id string, embedding array<float>, text string")
    import pytest

    with pytest.raises(Exception):
        VC.save_points(bad, path, dim=2)
    assert VC.read_points(spark, path).count() == 3  # a failed upsert leaves the collection intact
    with pytest.raises(ValueError):
        VC.ensure_collection(spark, path, 3)
    one = F.lit("s").alias("source"), F.lit("file").alias("kind")
    long = spark.range(5).select(F.concat(F.lit("s"), "id").alias("point_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"), *one)
    VC.save_points(long, path)
    VC.save_points(long.where("id < 2"), path)  # a shorter upload of a source leaves no tail
    assert VC.read_points(spark, path).where("source = 's'").count() == 2
    VC.delete_points(spark, path, {"source": "s"})
    assert VC.read_points(spark, path).count() == 3
    assert VC.drop_collection(spark, path) and not VC.drop_collection(spark, path)


def test_listing_from_files(spark, tmpdir_path):
    from docweave.sources import listing as LS

    staging = os.path.join(tmpdir_path, "staging")
    _stage(staging, "pdfs/a.pdf", b"%PDF-1")
    _stage(staging, "txts/b.txt", b"hello")
    _stage(staging, "txts/sub/c.txt", b"")
    _stage(staging, "other/x.bin", b"zz")
    lst = LS.list_objects(spark, staging, include_etag=True)
    rows = {r.name: (r.size, r.etag, r.is_dir) for r in lst.collect()}
    assert rows["pdfs/a.pdf"][0] == 6 and rows["txts/b.txt"][1] == "5d41402abc4b2a76b9719d911017c592"
    assert set(rows) == {"pdfs/a.pdf", "txts/b.txt", "txts/sub/c.txt", "other/x.bin"}
    assert sorted(r.name for r in LS.typed_listing(lst, "txt").collect()) == ["txts/b.txt", "txts/sub/c.txt"]
    cat = LS.catalog_all(lst)
    assert sorted((r.type, r.name) for r in cat.collect()) == [("pdf", "pdfs/a.pdf"), ("txt", "txts/b.txt"), ("txt", "txts/sub/c.txt")]
    assert LS.catalog_all(lst, "docx").count() == 0
    assert [r.name for r in LS.file_info(lst, "pdf", "a.pdf").collect()] == ["pdfs/a.pdf"]
    names_only = LS.list_objects(spark, staging, prefix="pdfs", include_metadata=False)
    assert [r.name for r in names_only.collect()] == ["pdfs/a.pdf"]
    # metadata listings never read file bodies
    plan = lst.drop("etag")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in LS.list_objects(spark, staging).columns and "etag" not in plan
