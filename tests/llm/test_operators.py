"""Operators against plain Python versions, on small tables with nulls, empty and long texts, ties,
repeated rows and clashing extra columns; and on empty tables."""

import hashlib
import math
import os
import random
import re
import tempfile
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docweave.llm import op01_decontamination as op1
from docweave.llm import op02_chat_formatting as op2
from docweave.llm import op03_best_fit_packing as op3
from docweave.llm import op04_ngram_jaccard as op4
from docweave.llm import op05_url_filters as op5
from docweave.llm import op06_suffix_array_dedup as op6
from docweave.llm import op07_language_id as op7
from docweave.llm import op08_quality_classifier as op8
from docweave.llm import op09_substring_dedup as op9
from docweave.llm import op10_embedding_neardup as op10
from docweave.llm import repeats
from docweave.llm.repeats import find_repeats
from docweave.session import ensure_checkpoint_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(s):
    return s.encode().lower().decode()


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, long = words(rng, 70), words(rng, 3000)
    rows = [(i, words(rng, rng.randrange(1, 200))) for i in range(40)]
    rows += [(100 + i, words(rng, 60) + " " + passage + " é " + words(rng, rng.randrange(30))) for i in range(12)]
    rows += [(200 + i, rows[3][1]) for i in range(6)]  # exact copies
    for i in range(8):  # near copies
        w = rows[41][1].split()
        w[i * 5] = "changed"
        rows.append((300 + i, " ".join(w)))
    rows += [(400, None), (401, ""), (402, "  \t\n"), (403, "one two"), (404, "one two"), (405, long), (406, long[500:9000] + " x")]
    rows += [(407, "ab " * 300), (408, "ab " * 200), (409, "a" * 400), (410, "b" + "a" * 300), (411, "Ünïcode " * 30)]
    rows += [(500, "twice the same row " * 20)] * 2 + [(None, passage), (None, passage), (501, "ÉCOLE A b C d E")]
    return rows


# -- 1 --------------------------------------------------------------------------------------------


def plain_hits(text, items):
    gap = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = [x for x in gap.split(lower(text or "")) if x]
    hit, found = set(), set()
    for item, t in items:
        b = [x for x in gap.split(lower(t or "")) if x]
        n = min(10, len(b))
        grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def bench_items(texts):
    w = texts[5][1].split()
    return [(1, " ".join(w[:25]).upper()), (12, "w1 w2"), (3, None), (4, "..."), (None, texts[7][1]), (12, "w1 w2"), (7, "one")]


def test_decontamination(spark, texts, monkeypatch):
    items = bench_items(texts)
    docs = docs_frame(spark, texts).withColumn("n_words", F.lit(1)).withColumn("items", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(i), *map(str, plain_hits(t, items))) for i, t in texts)
    for block in (op1.MAX_BROADCAST_WINDOWS, 7):  # 7: the benchmark in several scans
        got = op1.find_hits(docs, bench, block=block).select("doc_id", "n_words", op1.covered(F.col("hits")), "items")
        assert sorted((str(r[0]), *map(str, r[1:])) for r in got.collect()) == want
    clean = op1.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(key, clean.collect())) == sorted(map(key, [x for x in texts if not plain_hits(x[1], items)[1]]))
    cut = {r["doc_id"]: r["text"] for r in op1.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[5].split()[:1] != texts[5][1].split()[:1] and plain_hits(cut[5], items[:1])[1] == 0 and cut[400] is None
    assert cut[403] == " two"


def test_decontamination_empty(spark, texts):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = docs_frame(spark, texts[:3])
    assert op1.decontaminate(docs, bench).count() == 3
    assert op1.find_hits(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


# -- 2 --------------------------------------------------------------------------------------------


def test_chat_formatting(spark):
    a = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", None)]
    convs = {1: a[:2], 2: a, 3: a[:1], 4: [("user", "other")], 5: a, 6: [("user", "hi"), ("assistant", "hullo")], 7: [(None, "hi")]}
    rows = [(c, k, r, t, 1) for c, turns in convs.items() for k, (r, t) in enumerate(turns)] + [(None, 0, "user", "lost", 1)]
    rows += [(8, None, "user", "same"), (8, None, "user", "same")] and [(8, None, "user", "same", 1), (8, None, "user", "same", 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r["conv_id"]: r for r in op2.format_chats(df).collect()}
    assert set(got) == {2, 4, 6, 7, 8}  # 1 and 3 are prefixes of 2, 5 is its copy
    assert got[2]["n_copies"] == 2 and got[2]["n_turns"] == 4
    assert got[2]["rendered"].startswith("<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n")
    assert got[7]["rendered"] == "<|unknown|>\nhi<|end|>\n" and got[8]["n_turns"] == 2
    assert op2.format_chats(df.limit(0)).count() == 0


# -- 3 --------------------------------------------------------------------------------------------


def test_packing_plan():
    rng = random.Random(2)
    for capacity in (10, 64, 1024):
        for _ in range(20):
            sizes = {rng.randint(1, capacity): rng.randint(1, 400) for _ in range(rng.randint(1, 40))}
            plan = op3.plan_packing(sizes, capacity)
            held = {}
            for count, runs in plan:
                assert count > 0 and sum(s * n for s, n in runs) <= capacity
                assert sum(n for s, n in runs if 3 * s > capacity) <= 2
                for s, n in runs:
                    held[s] = held.get(s, 0) + count * n
            assert held == sizes
            bins, volume = sum(c for c, _ in plan), sum(s * n for s, n in sizes.items())
            assert bins >= math.ceil(volume / capacity)
            assert bins <= plain_best_fit(sizes, capacity) + 2
    assert op3.plan_packing({}, 10) == []


def plain_best_fit(sizes, capacity):
    gaps = []
    for s in sorted((s for s, n in sizes.items() for _ in range(n)), reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is None:
            gaps.append(capacity - s)
        else:
            gaps[gaps.index(fit)] -= s
    return len(gaps)


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(op3.default_tokenizer()[0])
    rows = [*texts, (600, "日本語 текст\u2009½ \x0b tail"), (601, "a <|endoftext|> b"), (602, words(random.Random(3), 4000))]
    docs = docs_frame(spark, rows).withColumn("offset", F.lit(3)).withColumn("length", F.lit(3))
    got = op3.pack_documents(docs, with_ids=True).collect()
    by_doc, by_bin = {}, {}
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 1024
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_bin.values():
        end = 0
        for at, n in sorted(own):
            assert at == end
            end += n
        assert end <= 1024
    for i, text in rows:
        if i is None or i == 500:
            continue
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == ids
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert all(r["length"] == 1024 for r in own[1:])
    assert len(by_doc[500]) == 2 and len(by_doc[None]) == 2 and len(by_doc[400]) == 1
    assert op3.pack_documents(docs.limit(0)).count() == 0


def test_both_tokenizers_agree():
    files = op3.default_tokenizer()
    both, full = op3._encoder(files), op3._encoder((files[0], None))
    rng = random.Random(4)
    letters = "abcdefghijXYZ 0123456789'’.,!?-\n\t\r éàüßñÄ½\xa0$€<|>"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(80)))
        assert both(text) == full(text)


# -- 4 --------------------------------------------------------------------------------------------


def plain_components(rows, n_words, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets.append({tuple(w[i : i + n_words]) for i in range(max(1, len(w) - n_words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if None in (rows[i][0], rows[j][0]):
                continue
            if same_id or (x and y and 100 * len(x & y) >= percent * len(x | y)):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((str(d), len(s), str(low.get(find(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_jaccard(spark, texts):
    rng = random.Random(6)
    base = words(rng, 120).split()
    chain = []
    for k in range(10):  # neighbours link, ends do not
        base[k * 11] = f"new{k}"
        chain.append((700 + k, " ".join(base)))
    rows = [*texts, *chain]
    docs = docs_frame(spark, rows).withColumn("n", F.lit(1)).withColumn("component_id", F.lit(1))
    for n_words, percent in ((4, 85), (5, 80), (1, 50)):
        got = op4.near_duplicates(docs, n_words, percent).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == plain_components(rows, n_words, percent)
    kept = op4.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for d, _, c in plain_components(rows, 5, 80) if c != "None"}
    assert sorted(str(i) for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_texts_that_share_a_doc_id_are_judged_apart(spark):
    rng = random.Random(31)
    a, b, c, d = (words(rng, 60, 90_000) for _ in range(4))
    rows = [(3, a), (5, a + " end"), (5, b), (6, c), (6, d), (6, d), (7, d + " end"), (8, None), (8, ""), (None, b)]
    got = op4.keep_one_of_each(docs_frame(spark, rows)).select("doc_id", "text").collect()
    want = [(3, a), (5, b), (6, c), (6, d), (8, None), (8, ""), (None, b)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_jaccard_empty(spark, texts):
    assert op4.near_duplicates(docs_frame(spark, texts).limit(0)).count() == 0
    assert [tuple(r) for r in op4.near_duplicates(docs_frame(spark, [(1, None)])).select("n_shingles", "component_id").collect()] == [(0, 1)]


# -- 5 --------------------------------------------------------------------------------------------


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = re.match(r"[^/?#]*", rest).group() if rest is not None else ""
    path = re.match(r"[^?#]*", rest[len(host) :]).group() if rest is not None else ""
    host = lower(host)
    fit = [(h.count("."), len(p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls(spark):
    rules = [*op5.RULES, ("block", "a.com", "/x/yy/z"), ("allow", "a.com", "/x/"), ("block", "net", "/q"), ("allow", "net", "/q"), ("block", "a.com", "/x/y/")]
    hosts = ["example.org", "WWW.Example.ORG", "org", "a.com", "b.a.com", "xa.com", "net", "com", "", "example.org:80", "u@a.com", "ex..net"]
    paths = ["", "/", "/es/", "/es", "/es/x", "/en/1", "/en/12/3", "/en/2", "/fr/", "/de/1?x=://org/", "/x/yy/zz", "/x/yy/", "/x/y/", "/x/y", "/q", "/qr/s", "//x", "#f/es/", "?a/b"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "example.org/es/", "://org/es/", "a://b.org/x://c.com/de/"]
    df = spark.createDataFrame([(i, u, "html", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in op5.filter_urls(df, rules).collect()}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}
    assert op5.filter_urls(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        op5.filter_urls(df, [("maybe", "org", "/")])


# -- 6, 9 -----------------------------------------------------------------------------------------


def plain_repeats(rows, tokens, width):
    first = {}
    for d, t in rows:
        own = tokens(t)
        for i in range(len(own) - width + 1 if d is not None else 0):
            gram = own[i : i + width] if isinstance(own, bytes) else tuple(own[i : i + width])
            first[gram] = min(first.get(gram, d), d)
    out = []
    for d, t in rows:
        own = tokens(t)
        cover = [False] * len(own)
        for i in range(len(own) - width + 1 if d is not None else 0):
            gram = own[i : i + width] if isinstance(own, bytes) else tuple(own[i : i + width])
            if first[gram] < d:
                cover[i : i + width] = [True] * width
        out.append((d, own, cover))
    return out


def test_repeated_bytes(spark, texts, monkeypatch):
    docs = docs_frame(spark, texts).withColumn("n_bytes", F.lit("clash"))
    want = []
    for d, own, cover in plain_repeats(texts, lambda t: (t or "").encode(), 50):
        kept = bytes(b for b, c in zip(own, cover) if not c)
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        want.append((str(d), len(own), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for step in (op6.STEP, 700):  # 700: long texts in many steps
        monkeypatch.setattr(op6, "STEP", step)
        got = find_repeats(docs, op6.DigestWindows()).select(cols).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    cut = op6.remove_repeated_substrings(docs)
    assert cut.columns == docs.columns and cut.count() == len(texts)
    by_id = {r["doc_id"]: r for r in cut.collect()}
    assert by_id[400]["text"] is None and by_id[200]["text"] == "" and by_id[200]["n_chars"] == 0
    assert by_id[411]["text"] == "Ünïcode " * 30
    assert find_repeats(docs.limit(0), op6.DigestWindows()).count() == 0


def test_repeated_words(spark, texts):
    rng = random.Random(9)
    few = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    common = few(55)
    runs = [(800 + i, few(40) + " " + common + " " + few(i)) for i in range(20)]
    runs += [(830, "z " * 130), (831, "q " + "z " * 49), (832, "z " * 50 + "q"), (833, "x y " * 60), (834, "y " + "x y " * 40)]
    rows = [*texts, *runs]
    docs = docs_frame(spark, rows).withColumn("kept_sha256", F.lit(1))
    want = []
    for d, own, cover in plain_repeats(rows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""), 50):
        kept = " ".join(w for w, c in zip(own, cover) if not c)
        want.append((str(d), len(own), sum(cover), hashlib.sha256(kept.encode()).hexdigest()))
    got = find_repeats(docs, op9.DigestWordWindows()).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert op9.remove_repeated_words(docs.limit(0)).count() == 0


@pytest.mark.parametrize("spec,cut", [(op6.DigestWindows, str.encode), (op9.DigestWordWindows, str.split)])
def test_hot_anchors_are_in_no_slice_as_a_whole(spark, monkeypatch, spec, cut):
    """A line in every document, its surroundings different: no slice gets most of its windows."""
    monkeypatch.setattr(repeats, "HOT_WINDOWS", 500, raising=False)
    rng = random.Random(4)
    least = lambda t: op6.mix(op6.ranks(np.frombuffer(t.encode(), np.uint8), op6.SAMPLE)).min()
    line = min((words(rng, 4, 90_000) for _ in range(2000)), key=least) if spec is op6.DigestWindows else "line " * 40
    rows = [(i, words(rng, 30, 90_000) + " " + line + " " + words(rng, 30, 90_000)) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(0, 400, 9)]  # repeats around the line, too
    none = pa.table({"_blk": [], "kind": [], "x": [], "y": [], "data": []}, schema=pa.schema([("_blk", pa.int32()), ("kind", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("data", pa.binary())]))
    blocks = [pa.table({"_blk": [b] * len(x), "doc_id": [i for i, _ in x], "text": [t for _, t in x], "_th": [0] * len(x)}) for b in range(4) for x in [rows[b::4]]]
    sent = pa.concat_tables([repeats._send_keys(spec(), 16)(x, none) for x in blocks])
    told = pa.concat_tables([repeats._answer_keys(sent.filter(pc.equal(sent["slice"], k))) for k in range(16)])
    size = dict.fromkeys(range(16), 0)
    for b, x in enumerate(blocks):
        got = repeats._send_segments(spec(), 16)(x, told.filter(pc.equal(told["_blk"], b)))
        for k, data in zip(got["slice"].to_pylist(), got["data"].to_pylist()):
            size[k] += len(data) if data[:4] != repeats.KNOWN else 0
    assert max(size.values()) < 0.2 * sum(size.values())
    for hot in (0, 500):  # 0: every shared anchor
        monkeypatch.setattr(repeats, "HOT_WINDOWS", hot, raising=False)
        n = {r[0]: r[1] for r in find_repeats(docs_frame(spark, rows), spec()).select("doc_id", "n_removed").collect()}
        assert n == {d: sum(cover) for d, _, cover in plain_repeats(rows, lambda t: cut(t), 50)}


@pytest.mark.parametrize("spec, tokens", [(op6.DigestWindows, lambda t: (t or "").encode()), (op9.DigestWordWindows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""))])
def test_parts_of_a_block(spark, monkeypatch, spec, tokens):
    """Blocks of many parts, of one, and of texts longer than a part give the same rows; copies lie in several parts."""
    rng = random.Random(21)
    shared = [words(rng, 70, 50_000) for _ in range(4)]
    rows = [(i, " ".join([words(rng, rng.randrange(0, 60), 50_000), rng.choice(shared), words(rng, 5, 50_000)])) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [(200, None), (201, ""), (202, " ".join(shared * 3)), (203, words(rng, 20_000, 50_000)), (203, None)]
    want = sorted((d, len(own), sum(cover)) for d, own, cover in plain_repeats(rows, tokens, 50))
    length = list(spec.results)[0]
    for part, block, least in ((1 << 20, 1 << 24, 3), (300, 1 << 24, 1), (2000, 9000, 2)):
        monkeypatch.setattr(repeats, "PART_BYTES", part)
        monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
        monkeypatch.setattr(repeats, "LEAST_BLOCKS", least)
        got = find_repeats(docs_frame(spark, rows), spec()).select("doc_id", length, "n_removed").collect()
        assert sorted(map(tuple, got)) == want


def test_messages_do_not_grow_with_slices():
    """A block's keys cost about as much whether they go to 32 slices or, as at 30 GB, to 1,920."""
    rng = random.Random(22)
    texts = [words(rng, 900, 90_000) for _ in range(1500)]
    docs = pa.table({"_blk": [0] * len(texts), "doc_id": list(range(len(texts))), "text": texts, "_th": [0] * len(texts)})
    none = pa.table({"_blk": [], "kind": [], "x": [], "y": [], "data": []}, schema=pa.schema([("_blk", pa.int32()), ("kind", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("data", pa.binary())]))
    for spec in (op6.DigestWindows(), op9.DigestWordWindows()):
        sent = [sum(map(len, repeats._send_keys(spec, n)(docs, none)["data"].to_pylist())) for n in (32, 1920)]
        assert sent[1] < 1.6 * sent[0]


def test_recompression_is_local():
    """Symbols over the middle of a sequence are the same whatever surrounds it."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        alphabet = rng.integers(1, 1 << 62, rng.integers(1, 12)).astype(np.uint64)
        middle = rng.choice(alphabet, 50)
        seen = set()
        for _ in range(4):
            a, b = rng.choice(alphabet, rng.integers(0, 40)), rng.choice(alphabet, rng.integers(0, 40))
            all_words = np.concatenate([a, middle, b])
            name, span = op9.recompress(all_words, np.zeros(len(all_words), int))
            at_word = np.repeat(name, span)[len(a) + op9.MARGIN : len(a) + 50 - op9.MARGIN]
            seen.add(at_word.tobytes())
        assert len(seen) == 1


# -- 7, 8 -----------------------------------------------------------------------------------------


def test_language_id(spark):
    rng = random.Random(11)
    stems = {"en": ["the", "ing", "tion", "and"], "fr": ["éau", "eux", "ment", "le"], "de": ["ung", "sch", "keit", "der"]}
    say = lambda l, n: " ".join("".join(rng.choices(stems[l], k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, say(l, rng.randint(5, 60)), l) for i in range(300) for l in [rng.choice(list(stems))]]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !!", "fr"), (1003, "ж", "en"), (1004, "THE ANDING TION " * 2000, None), (None, say("en", 9), "de"), (1003, "ж", "en")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = op7.identify_languages(docs, op7.learn(docs)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in got}
    assert np.mean([by_id[i]["lang_pred"] == l for i, _, l in rows]) > 0.98
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002, 1004)] == ["und", "und", "und", "en"]
    assert by_id[1003]["lang_pred"] in stems and all(0 <= r["score"] <= 1 for r in got)
    none = op7.learn(docs.limit(0))
    assert {r["lang_pred"] for r in op7.identify_languages(docs, none).collect()} == {"und"}
    assert op7.identify_languages(docs.limit(0), none).count() == 0


def test_language_ignores_labels_of_held_out(spark):
    docs = spark.createDataFrame([(i, "abc def " * 5, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else "en") for i in range(60)], "doc_id long, text string, lang string")
    assert op7.learn(docs).langs == ["en"]


def test_more_languages_than_a_mask_word_has_bits(spark):
    rng = random.Random(17)
    say = lambda k, n: " ".join(chr(0x4E00 + 40 * k + rng.randrange(40)) * 2 for _ in range(n))
    rows = [(10 * k + j, say(k, 60), f"l{k:03d}") for k in range(130) for j in range(4)]
    filters = op7.fit_filters(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(filters.langs) == 130
    assert all(filters.decide(say(k, 20), True)[0] == f"l{k:03d}" for k in range(130))


def test_false_positive_correction():
    rng = np.random.default_rng(1)
    grams = {"a": rng.integers(0, 1 << 32, 30_000).astype(np.uint32), "b": rng.integers(0, 1 << 32, 300).astype(np.uint32)}
    f = op7.LanguageFilters(grams, "a")
    other = rng.integers(0, 1 << 32, 50_000).astype(np.uint32)
    share = [((f.masks(other) >> np.uint64(k)) & np.uint64(1)).mean() for k in range(2)]
    assert np.allclose(share, f.false_rate, atol=0.003)
    assert all((((f.masks(grams[l]) >> np.uint64(k)) & np.uint64(1)) == 1).all() for k, l in enumerate("ab"))


def test_quality(spark):
    rng = random.Random(12)
    good = lambda: words(rng, rng.randint(30, 80), 5000).capitalize() + "."
    bad = lambda: " ".join([f"W{rng.randrange(9)}!!"] * rng.randint(20, 60)).upper()
    rows = [(i, good() if i % 3 else bad()) for i in range(300)] + [(1000, None), (1001, ""), (None, good()), (1, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)] + [(5000, 1, 0), (None, 1, 0), (3, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    vote = op8.fit_vote(docs, labels)
    got = [tuple(r) for r in op8.score_quality(docs, vote).select("doc_id", "score").collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    right = [(s >= 0.5) == bool(i % 3) for i, s in got if i is not None and i < 300 and i % 2 and i != 1]
    assert np.mean(right) > 0.98
    prior = {s for i, s in got if i in (1000, 1001)}
    assert len(prior) == 1
    none = op8.fit_vote(docs, labels.limit(0))
    assert {r["score"] for r in op8.score_quality(docs, none).collect()} == {0.5}
    assert op8.score_quality(docs.limit(0), vote).count() == 0


def test_blocked_votes_equal_plain_ones():
    rng = np.random.default_rng(2)
    x = np.abs(rng.normal(size=(300, op8.WIDTH))).astype(np.float32)
    y = rng.integers(0, 2, 300)
    vote = op8.NeighbourVote(x, y)
    probe = np.abs(rng.normal(size=(20, op8.WIDTH))).astype(np.float32)
    for row, score in zip(probe, vote.scores(probe)):
        v = row @ vote.project
        cosine = vote.vectors @ (v / np.linalg.norm(v))
        near = np.argsort(-cosine)[: op8.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** 8
        assert abs(score - (weight * y[near]).sum() / weight.sum()) < 1e-3


# -- 10 -------------------------------------------------------------------------------------------


def plain_links(rows, least):
    good = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[k] = np.array(np.float32(v), float)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]) == 8:
                if good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= least:
                    n[a], n[b] = n[a] + 1, n[b] + 1
                    root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted((str(i), n[k], str(low.get(find(k))), i is not None and low[find(k)] == i) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("tile,blocks,grid", [(16384, 8, 2), (40, 4, 2), (25, 3, 1), (16384, 2, 3)])
def test_vectors(spark, monkeypatch, tile, blocks, grid):
    monkeypatch.setattr(op10, "TILE", tile)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 9] + rng.normal(size=8) * 0.12).tolist()) for i in range(90)]
    rows += [(300 + i, (base[3] * (i + 1)).tolist()) for i in range(5)] + [(400 + i, base[4].tolist()) for i in range(30)]
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0] * 7 + [float("nan")]), (504, [float("inf")] + [1.0] * 7), (505, [None] + [1.0] * 7), (506, [1.0, 2.0]), (None, base[4].tolist())]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, members int")
    got = op10.near_duplicate_vectors(df, blocks=blocks, grid_dims=grid).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got) == plain_links(rows, 0.95)


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n, (dims, groups) in enumerate([(8, 12), (5, 6), (1, 1), (12, 1)]):
        for g in range(groups):
            base = rng.normal(size=dims)
            rows += [(1000 * n + 10 * g + k, (base + rng.normal(size=dims) * 0.1 * (k > 1)).tolist()) for k in range(5)]
    rows += [(5000, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    unit = {i: np.array(np.float32(v), float) / np.linalg.norm(np.float32(v).astype(float)) for i, v in rows}
    near = {i: {j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95} for i in unit}
    got = {r["vec_id"]: r for r in op10.near_duplicate_vectors(df).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(x) for i, x in near.items()}
    assert all(got[i]["component_id"] == got[j]["component_id"] <= i for i in near for j in near[i])
    assert all(near[i] for i in (0, 1000, 2000, 3000)) and got[1001]["component_id"] == 1000


def test_vectors_of_a_cell_in_bounded_memory():
    """All pairs of a cell of near copies are links; none of them are kept."""
    n, dims = 3000, 8
    rng = np.random.default_rng(2)
    raw = (np.ones(dims) + rng.normal(size=(n, dims)) * 1e-3).astype(np.float32)
    unit = op10.unit_rows(raw.astype(float))
    space = op10.Subspaces(unit.T @ unit, n, 1, 2, 0.95)
    steps = space.steps(unit)
    zero = pa.array(np.zeros(n, np.int32))
    group = {"cell": ["0:0,0"] * n, "t1": zero, "t2": zero, "second": zero, "guest": zero, "vec_id": np.arange(n) + 10, "members": np.full(n, 2)}
    group = pa.table(group | {"steps": [x.tobytes() for x in steps], "raw": [x.tobytes() for x in raw]})
    tracemalloc.start()
    got = op10._compare(SimpleNamespace(value=space), dims, 0.95)(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20  # the pairs alone are 72 MB
    assert set(got["n"].to_pylist()) == {2 * (n - 1)} and set(got["root"].to_pylist()) == {10}


def test_vectors_are_written_a_few_times_at_most(spark):
    """Shuffle files and staged tables together, of vectors that fill the space evenly."""
    n, dims = 12_000, 32
    rng = np.random.default_rng(4)
    raw = rng.normal(size=(n, dims)).astype(np.float32)
    raw[n // 2 : n // 2 + 200] = raw[:200] + rng.normal(size=(200, dims)).astype(np.float32) * 0.01
    path = f"{tempfile.mkdtemp(prefix='docweave-test-')}/vectors.parquet"
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(raw), pa.list_(pa.float32()))}), path)
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")

    def held():
        local, files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator(), {}
        while local.hasNext():
            f = local.next()
            files[f.getPath()] = f.length()
        return files | {f"{d}/{x}": os.path.getsize(f"{d}/{x}") for d, _, names in os.walk(folder) for x in names}

    before = held()
    got = op10.near_duplicate_vectors(spark.read.parquet(path)).collect()
    written = sum(size for f, size in held().items() if f not in before)
    assert len(got) == n and sorted(r["vec_id"] for r in got if r["n_links"]) == [*range(200), *range(n // 2, n // 2 + 200)]
    assert written < 4 * raw.nbytes, written / raw.nbytes


def test_vectors_whose_hashes_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(op10, "_digest", lambda embedding: F.pmod(F.xxhash64(embedding), F.lit(3)))
    monkeypatch.setattr(op10, "TILE", 40)
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, base[i % 7].tolist()) for i in range(60)]
    rows += [(200 + i, (base[i % 5] + rng.normal(size=8) * 0.1).tolist()) for i in range(40)]
    rows += [(300, [0.0, -0.0] + [1.0] * 6), (301, [-0.0, 0.0] + [1.0] * 6), (302, None), (None, base[1].tolist())]
    got = op10.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got) == plain_links(rows, 0.95)


@pytest.mark.parametrize("dims,least", [(24, 0.95), (24, 0.3), (3, 0.95), (24, -0.2)])
def test_tiles_meet_as_all_their_pairs(monkeypatch, dims, least):
    """Even vectors, near copies of some, opposite ones, and one whose neighbours cancel out."""
    for name, value in (("NEIGHBOURS", 16), ("GROUP", 5), ("HOODS_AT_ONCE", 3), ("SCORES_AT_ONCE", 90), ("PAIRS_AT_ONCE", 64), ("NUMBERS_AT_ONCE", 200), ("ROWS_AT_ONCE", 50)):
        monkeypatch.setattr(op10, name, value)
    rng = np.random.default_rng(11)
    raw = rng.normal(size=(500, dims)).astype(np.float32)
    raw[200:260] = raw[:60] + rng.normal(size=(60, dims)) * 0.15
    raw[260:400] = raw[7] + rng.normal(size=(140, dims)) * 0.01
    raw[400:420] = -raw[:20]
    cell = np.concatenate([rng.integers(0, 9, 400), np.arange(100) % 3])
    cell[[0, 400]] = 90
    members = rng.integers(1, 4, 500)
    unit = op10.unit_rows(raw.astype(float))
    space = SimpleNamespace(value=op10.Subspaces(unit.T @ unit, 500, 4, 2, least))
    links = op10._compare(space, dims, least)
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)

    def table(of):
        of = of[np.argsort(cell[of], kind="stable")]
        return pa.table({"cell": cell[of], "vec_id": of, "members": members[of], "raw": [raw[k].tobytes() for k in of]})

    def check(got, near):
        assert dict(zip(got["vec_id"].to_pylist(), got["n"].to_pylist(), strict=True)) == {i: n for i, n in enumerate((near @ members).tolist()) if n}
        low = np.arange(500)
        for _ in range(500):
            low = np.minimum(low, np.where(near, low, 500).min(1))
        assert dict(zip(got["vec_id"].to_pylist(), got["root"].to_pylist(), strict=True)) == {i: low[i] for i in np.flatnonzero(near.any(1)).tolist()}

    check(links(table(np.arange(500))), near)
    one = np.flatnonzero(rng.random(500) < 0.5)
    across = near.copy()
    across[np.ix_(one, one)] = False
    two = np.setdiff1d(np.arange(500), one)
    across[np.ix_(two, two)] = False
    check(links(table(one), table(two)), across)


def test_vectors_empty(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in op10.near_duplicate_vectors(df).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert op10.near_duplicate_vectors(df.limit(0)).count() == 0
