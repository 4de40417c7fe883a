"""The stages one after the other against plain versions, on a small fixture with planted cases."""

import random
import zlib

import corpus_pipeline as pipeline

from test_operators import docs_frame, plain_components, plain_hits, plain_repeats, words


def planted():
    rng = random.Random(21)
    item = words(rng, 30, 90_000)
    rows = [(i, words(rng, rng.randint(20, 90), 90_000)) for i in range(40)]
    rows += [(50, rows[2][1]), (51, rows[2][1] + " end"), (52, "123 456"), (53, None)]
    rows += [(54, words(rng, 15, 90_000) + " " + item[20:120] + " " + words(rng, 9, 90_000)), (55, words(rng, 20, 90_000) + " " + rows[4][1])]
    return rows, [(1, item)]


def test_stages(spark, tmpdir_path):
    rows, items = planted()
    docs = docs_frame(spark, rows).withColumn("lang", pipeline.F.lit("en"))
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmpdir_path}/documents.parquet")
    columns, left = docs.columns, rows
    plain = {
        "language_id": lambda x: [r for r in x if r[0] not in (52, 53)],
        "ngram_jaccard": lambda x: [r for r in x if any(d == c == str(r[0]) for d, _, c in plain_components(x, 5, 80))],
        "suffix_array_dedup": lambda x: [
            (d, bytes(b for b, gone in zip(own, cover) if not gone).decode())
            for d, own, cover in plain_repeats(x, lambda t: t.encode(), 50)
        ],
        "decontamination": lambda x: [r for r in x if not plain_hits(r[1], items)[1]],
    }
    assert [n for n, _ in pipeline.STAGES[:-1]] == list(plain)
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.staged(stage(spark, docs, tmpdir_path))
        assert docs.columns == columns
        left = plain[name](left)
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(left)
    got = pipeline.run(spark, tmpdir_path)
    assert {r["doc_id"] for r in got.collect()} == {d for d, _ in left}
    assert 54 not in dict(left) and 50 not in dict(left) and 55 in dict(left)


def test_no_documents(spark, tmpdir_path):
    rows, items = planted()
    docs_frame(spark, rows).limit(0).write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    assert pipeline.run(spark, tmpdir_path).count() == 0


def test_language_stage_without_labels(spark):
    rows = [(i, words(random.Random(i), 30), None, "s", 1) for i in range(6)] + [(6, "12 34", None, "s", 1), (7, None, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in pipeline.known_language(spark, docs, "").collect()} == set(range(6))
    # no letter stays out whatever its label; und may be a label like any other
    docs = docs.withColumn("lang", pipeline.F.lit("und"))
    assert {r["doc_id"] for r in pipeline.known_language(spark, docs, "").collect()} == set(range(6))


def test_language_stage_learns_from_all_labels(spark):
    fold = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1][:2]
    rows = [(1000 + i, "the thing and the ending of the evening " * 3, "en") for i in range(20)]
    rows += [(fold[0], "съешь же ещё этих мягких французских булок", "ru"), (fold[1], "ξεσκεπάζω την ψυχοφθόρα βδελυγμία σου", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = {r["doc_id"] for r in pipeline.known_language(spark, docs, "").collect()}
    assert fold[0] in left and len(left) == 21 + (len(rows[-1][1]) < pipeline.MIN_CHARS)
