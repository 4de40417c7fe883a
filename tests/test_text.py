"""Edge cases of the text functions, with hand-written expected values."""

from pyspark.sql import functions as F

from docweave.functions import text as TX


def one(spark, col_fn, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(col_fn(F.col("v"))).collect()]


def test_clean_text(spark):
    got = one(spark, TX.clean_text, ["a\tb\x0bc\x1cd\x85e\xa0f", "wo\x07rd", "a \x00", "", None, "  x  \n\n y "])
    assert got == ["a b c d e f", "word", "a ", "", "", "x y"]


def test_title_from_filename(spark):
    got = one(spark, TX.title_from_filename, ["tnc.shopee it's 3d.pdf", "a_b-c.TXT", "élan_vital-ÉTÉ.txt", "nodot", "x.y.z"])
    assert got == ["Tnc.Shopee It'S 3D", "A B C", "Élan Vital Été", "Nodot", "X.Y"]


def test_title_from_content(spark):
    texts = [
        "abcde\nsecond line here",  # first line too short (5), second qualifies
        "abcdef\nx",  # 6 chars qualifies
        "a" * 100 + "\nnext",  # 100 qualifies
        "b" * 101 + "\nsix chars",  # 101 too long -> next line
        "Author: someone\nReal Title Here",  # metadata line skipped
        "\n\n\n\n\nonly after five blank lines. more",  # fallback: first sentence
        "x" * 120,  # fallback without '.' or newline: first 100
        "   ",
        None,
        ".leading dot line is long enough",  # first line qualifies as is
    ]
    got = one(spark, TX.title_from_content, texts)
    assert got == [
        "second line here",
        "abcdef",
        "a" * 100,
        "six chars",
        "Real Title Here",
        "only after five blank lines.",
        "x" * 100,
        None,
        None,
        ".leading dot line is long enough",
    ]


def test_title_from_content_fallbacks(spark):
    # no usable line among the first five -> first 100 stripped characters, cut after the first '.'
    got = one(spark, TX.title_from_content, ["ab\ncd\nef\ngh\nij\nthe rest. tail", "ab\ncd", ".x"])
    assert got == ["ab\ncd\nef\ngh\nij\nthe rest.", "ab", "."]


def test_truncate(spark):
    t800 = "a" * 800 + " " + "b" * 300  # space at index 800: not past 80 %, no cut
    t801 = "a" * 801 + " " + "b" * 300  # space at index 801: cut there
    got = one(spark, TX.truncate_text, ["a" * 1000, "a" * 1001, t800, t801, "x"])
    assert [len(g) for g in got] == [1000, 1003, 1003, 804, 1]
    assert got[3] == "a" * 801 + "..."


def test_source_link(spark):
    lines = "\n".join(["line"] * 10 + ["Source: https://late.example.com"])
    got = one(
        spark,
        TX.source_link,
        ["Source: HTTPS://Ex.com/A b", lines, "source: no url here\nurl: http://x.org/p", "http://no.prefix.com", None],
    )
    assert got == ["https://ex.com/a", None, "http://x.org/p", None, None]


def test_validate_text_content(spark):
    ok9, ok10 = " 123456789 ", "1234567890"
    ctrl = "abcdefgh\x01\x02"  # 8 of 10 printable: exactly 0.8 -> ok
    ctrl2 = "abcdefg\x01\x02\x03"  # 0.7 -> rejected
    zw = "abcdefghij" + "​" * 3  # zero-width spaces are format characters: 10/13 < 0.8
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["", "   ", ok9, ok10, ctrl, ctrl2, zw, None])], "i int, v string")
    got = [tuple(r) for r in df.orderBy("i").select(TX.validate_text_content("v").alias("s")).select("s.ok", "s.reason").collect()]
    assert got == [
        (False, "Text content is empty"),
        (False, "Text content is empty"),
        (False, "Text content is too short (minimum 10 characters)"),
        (True, None),
        (True, None),
        (False, "Text contains too many non-printable characters"),
        (False, "Text contains too many non-printable characters"),
        (False, "Text content is empty"),
    ]


def test_hashes_and_ids(spark):
    df = spark.createDataFrame([(bytearray(b"abc"), 1704067200)], "b binary, e long")
    r = df.select(
        TX.content_md5("b").alias("m"), TX.content_sha256("b").alias("s"), TX.document_id("txt", TX.content_sha256("b"), "e").alias("id")
    ).first()
    assert r.m == "900150983cd24fb0d6963f7d28e17f72"
    assert r.s == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert r.id == "txt_ba7816bf8f01cfea_1704067200"


def test_paths_and_time(spark):
    df = spark.createDataFrame([("silver/pdfs/a.md", "2024-01-01 20:30:00")], "p string, t string")
    b, k = TX.split_bucket_key("p")
    r = df.select(
        b.alias("b"), k.alias("k"), TX.basename("p").alias("n"),
        TX.local_time(F.col("t").cast("timestamp_ntz")).alias("lt"), TX.local_iso(F.col("t").cast("timestamp_ntz")).alias("iso"),
    ).first()
    assert (r.b, r.k, r.n) == ("silver", "pdfs/a.md", "a.md")
    assert r.lt == "2024-01-02 03:30:00"
    assert r.iso == "2024-01-02T03:30:00+07:00"
