"""Columns that clash with the operators' own, rules beyond the broadcast, components of 64 bits, hot languages,
very long texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import op01_decontamination as op1
from docweave.llm import op04_ngram_jaccard as op4
from docweave.llm import op05_url_filters as op5
from docweave.llm import op06_suffix_array_dedup as op6
from docweave.llm import op07_language_id as op7
from docweave.llm import op10_embedding_neardup as op10
from docweave.llm.repeats import find_repeats

CLASHES = ["_id", "_TH", "_blk", "_hits", "_pieces", "_rows", "N_BYTES", "n_removed", "KEPT_TEXT", "_judged"]


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    passage = words(40)
    rows = [(i, words(60) + " " + (passage if i % 3 == 0 else "") + " " + words(20)) for i in range(12)]
    rows += [(100, rows[1][1]), (101, rows[1][1] + " end"), (102, rows[2][1]), (102, words(30)), (None, None), (103, None), (104, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    df = df.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHES})
    return df, spark.createDataFrame([(1, passage)], "item_id long, text string"), rows


def _kept(df):
    for r in df.collect():
        for c in CLASHES:
            assert r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}"
    return df.columns


def test_clashing_columns_stay_as_they_are(spark, clashing):
    df, benchmark, rows = clashing
    plain = df.select("doc_id", "text", "n_chars")
    own = lambda d: sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in d.select("doc_id", "text").collect()))
    for remove in ("documents", "spans"):
        out = op1.decontaminate(df, benchmark, remove=remove)
        assert _kept(out) == df.columns and own(out) == own(op1.decontaminate(plain, benchmark, remove=remove))
    out = op4.keep_one_of_each(df)
    assert _kept(out) == df.columns and own(out) == own(op4.keep_one_of_each(plain)) and out.count() < len(rows)
    out = op6.remove_repeated_substrings(df)
    assert _kept(out) == df.columns and own(out) == own(op6.remove_repeated_substrings(plain)) and out.count() == len(rows)
    out = find_repeats(df, op6.DigestWindows())
    assert {"n_bytes", "n_removed", "n_spans", "kept_sha256"} <= set(out.columns) and not {"N_BYTES"} & set(out.columns)
    pages = df.select("doc_id", F.concat(F.lit("http://a.org/"), F.col("doc_id")).alias("url"), *CLASHES)
    assert set(CLASHES) <= set(_kept(op5.filter_urls(pages)))


def test_rules_beyond_the_broadcast_are_joined(spark, monkeypatch):
    rng = random.Random(4)
    hosts = ["org", "example.org", "www.example.org", "com", "a.com", "b.a.com", "net", "xn--p1ai"]
    paths = ["/", "/a", "/a/", "/a/b", "/ab", "/a/b/c", "/é/", "/x/y"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(60)]
    urls = [f"http://{rng.choice(['', 'm.', 'x.y.'])}{rng.choice([*hosts, 'other.io', 'EXAMPLE.org'])}{rng.choice([*paths, '', '/a/bc?q', '/abc#f', '/a//b'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "http://", "://org/a", "http://org" + "/a" * 5000, "http://" + "l." * 50 + "org/"]
    pages = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls)], "page_id long, url string, _host string")
    for some in (rules, spark.createDataFrame(rules, "verdict string, host string, path string")):
        monkeypatch.setattr(op5, "MAX_RULES", 200_000)
        by_trie = op5.filter_urls(pages, some)
        monkeypatch.setattr(op5, "MAX_RULES", 3)
        by_join = op5.filter_urls(pages, some)
        assert by_join.columns == by_trie.columns
        assert sorted(map(str, by_join.collect())) == sorted(map(str, by_trie.collect()))
    with pytest.raises(Exception, match="not a rule"):
        op5.filter_urls(pages, [*rules, ("maybe", "org", "/")]).collect()


def test_vectors_in_double_precision(spark):
    """Pairs a billionth to both sides of the threshold, and components whose squares overflow."""
    rows, want = [], {}
    for k, c in enumerate([0.95 - 1e-9, 0.95 + 1e-9, 0.95 - 1e-12, 0.95 + 1e-12]):
        for j, v in enumerate([[1.0, 0.0], [c, float(np.sqrt(1 - c * c))]]):
            full = [0.0] * 10
            full[2 * k : 2 * k + 2] = v
            rows.append((10 * k + j, full))
            want[10 * k + j] = int(c > 0.95)
    rows += [(100, [0.0] * 8 + [1e300, 2e300]), (101, [0.0] * 8 + [1e300, 2e300]), (102, [0.0] * 8 + [1e-300, 2e-300])]
    want |= {100: 2, 101: 2, 102: 2}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in op10.near_duplicate_vectors(df).collect()}
    assert got == want


def test_the_prior_is_the_most_frequent_language_and_the_sample_its_smallest_hashes(spark):
    rng = random.Random(1)
    text = lambda lang: " ".join(rng.choice({"aa": ["lorem", "ipsum"], "en": ["hello", "world"], "zz": ["foo", "bar"]}[lang]) for _ in range(20))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["en"] * 180 + ["aa"] * 12 + ["zz"] * 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = op7.fit_filters(df, docs_per_lang=5)
    assert filters.prior == "en" and filters.langs == ["aa", "en", "zz"]
    plain = df.withColumn("h", F.xxhash64("doc_id")).collect()
    five = [r for lang in ("aa", "en", "zz") for r in sorted((r for r in plain if r["lang"] == lang), key=lambda r: r["h"])[:5]]
    again = op7.fit_filters(spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in five], df.schema))
    assert (again.rows == filters.rows).all()


def test_languages_by_exact_sets(spark):
    """Fit and decision repeated with plain sets and counts: shares differ by the filters' false positives only."""
    rng = random.Random(6)
    alphabet = {"aa": "abcdef", "bb": "defghi", "cc": "ghijkl"}
    word = lambda lang: "".join(rng.choice(alphabet[lang]) for _ in range(rng.randrange(2, 7)))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = op7.fit_filters(df)
    counts = {lang: {} for lang in alphabet}
    for _, t, lang in rows:
        for g in op7.grams_of(t).tolist():
            counts[lang][g] = counts[lang].get(g, 0) + 1
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = {g: max(share[lang].get(g, 0) for lang in alphabet) for c in counts.values() for g in c}
    sets = {lang: {g for g, n in counts[lang].items() if n >= 2 and share[lang][g] >= 0.25 * top[g]} for lang in alphabet}
    for _ in range(60):
        t = " ".join(word(rng.choice("aa bb cc".split())) for _ in range(rng.randrange(1, 12)))
        grams = op7.grams_of(t).tolist()
        exact = [sum(g in sets[lang] for g in grams) / len(grams) for lang in filters.langs]
        assert np.allclose(filters.shares(t), exact, atol=0.08)
        lang, score = filters.decide(t, True)
        assert exact[filters.langs.index(lang)] >= max(exact) - 0.08 and abs(score - max(exact)) <= 0.08


def test_very_long_texts(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(60_000))  # some 340 kB
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "short text of few words"), (4, long[200_000:])], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, " ".join(long.split()[-12:]))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in op1.decontaminate(df, benchmark).collect()) == [3]
    assert sorted(r["doc_id"] for r in op4.keep_one_of_each(df).collect()) == [1, 3, 4]
    kept = {r["doc_id"]: r["text"] for r in op6.remove_repeated_substrings(df).collect()}
    assert kept[1] == long and len(kept[2]) < 60 and kept[4] == ""
    judged = op7.identify_languages(df, op7.fit_filters(df.withColumn("lang", F.lit("en")))).collect()
    assert {r["lang_pred"] for r in judged} == {"en"}
