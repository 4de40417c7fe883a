"""Hard negatives, SentencePiece and fill-in-the-middle against plain versions: nulls, empty and very long texts,
ties, repeated rows, clashing extra columns, empty tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.llm import op11_hard_negatives as op11
from docweave.llm import op12_sentencepiece as op12
from docweave.llm import op13_fill_in_middle as op13

# -- 11 -------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, block int, dims string"


def plain_negatives(rows, every):
    """Brute force with Python integers over (vec_id, vector, label)."""
    good = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in good or (label, v) < good[i]:
            good[i] = (label, v)
    table = {i: ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, (label, v) in good.items()}
    out = []
    for a, (label, q) in table.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, r, strict=True)), b, other) for b, (other, r) in table.items() if b != a and len(r) == len(q)]
        positives = sorted((s, b) for s, b, other in scored if other == label)[:5]
        for ps, p in positives:
            fit = sorted((s, b) for s, b, other in scored if other != label and 50 * -ps <= 100 * -s <= 95 * -ps)[:3]
            out += [(a, p, k + 1, b, -ps, -s) for k, (s, b) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, every=5):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], VECTORS)
    got = op11.mine_hard_negatives(df, F.col("vec_id") % every == 0, op11.relabelled(F.col("label"), F.col("vec_id")))
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + rng.normal(size=8) * 0.4).tolist(), int(i % 6)) for i in range(150)]
    rows += [(200 + i, base[i % 6].tolist(), i % 3) for i in range(40)]  # equal vectors under several labels: ties
    rows += [(300 + i, (base[2] * (0.2 + i)).tolist(), i % 4) for i in range(12)]  # all lengths
    rows += [(400, [0.0] * 8, 1), (405, [0.0] * 8, 1), (410, None, 2), (411, [1.0] * 8, None), (None, [1.0] * 8, 1)]
    rows += [(412, [None] + [1.0] * 7, 1), (413, [float("nan")] * 8, 1), (414, [float("inf")] * 8, 1)]
    rows += [(420, [1.0, 2.0], 1), (425, [2.0, 1.0], 1), (426, [1.5, 1.0], 2), (427, [0.5, 1.0], 3), (430, [], 1), (431, [], 1)]
    rows += [rows[5]] * 3 + [(5, base[1].tolist(), 4), (150, base[0].tolist(), 0), (150, base[3].tolist(), 0)]  # repeated ids
    return rows


@pytest.mark.parametrize("least,bucket,anchors", [(1024, 1024, 4096), (8, 4, 7)])
def test_hard_negatives(spark, monkeypatch, vectors, least, bucket, anchors):
    monkeypatch.setattr(op11, "LEAST_BLOCK", least)
    monkeypatch.setattr(op11, "BUCKET", bucket)
    monkeypatch.setattr(op11, "MOST_ANCHORS", anchors)
    want = plain_negatives(vectors, 5)
    assert len(want) > 100 and any(a[4] == 0 for a in want)
    assert mined(spark, vectors) == want


def test_hard_negatives_of_floats_and_empty(spark):
    rng = np.random.default_rng(4)
    rows = [(i, np.float32(rng.normal(size=6)).tolist(), int(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    label = op11.relabelled(F.col("label"), F.col("vec_id"))
    got = sorted(tuple(r) for r in op11.mine_hard_negatives(df, F.col("vec_id") % 5 == 0, label).collect())
    assert got == plain_negatives(rows, 5)
    assert op11.mine_hard_negatives(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert op11.mine_hard_negatives(df, F.col("vec_id") < 0).count() == 0


def test_scores_stay_exact_where_doubles_would_round():
    vectors = np.array([[2.0**40, 1.0], [2.0**40, 2.0], [2.0**61, 2.0**61]])
    index = op11.Index(np.arange(3), np.zeros(3, np.int64), vectors)
    anchor = np.array([2.0**20, 1.0])
    assert index.scores(anchor, np.arange(2)).tolist() == [2**60 + 1, 2**60 + 2]
    assert index.scores(vectors[2], np.arange(2, 3)).tolist() == [op11.MAX_LONG]


def test_lists_rule_rows_out_and_lose_none():
    """Clustered directions: the ranges leave a small share of the rows to verify."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(20, 32))
    raw = centers[rng.integers(20, size=4000)] + rng.normal(size=(4000, 32)) * 0.05
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    shares = []
    for rows in (np.floor(256 * unit), np.floor(256 * raw)):  # of one length, and of many
        index = op11.Index(np.arange(4000), np.zeros(4000, np.int64), rows)
        anchors = range(0, 4000, 97)
        for a in anchors:
            ((ids, scores),) = index.search(a, rows[a], 5, [(-op11.MAX_LONG, op11.MAX_LONG)])
            every = rows @ rows[a]
            every[a] = -np.inf
            best = np.lexsort((np.arange(4000), -every))[:5]
            assert ids.tolist() == best.tolist() and scores.tolist() == every[best].tolist()
        shares.append(index.verified / (len(anchors) * 4000))
    assert shares[0] < 0.1 and shares[1] < 0.6


# -- 12 -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=op12.default_model())


@pytest.fixture(scope="module")
def pieces():
    return op12.Pieces(op12.default_model())


ALPHABET = list("abcehinorst ABC  \n\t.,▁▁01289éüßñ漢字の😀\0‍�") + ["the", "ing ", "</s>", "<s>", "<0x41>", "   "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=60))
def test_merges_equal_the_library(pieces, library, parts):
    text = "".join(parts)
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert pieces.encode(text) == ids
    assert pieces.decode(ids) == library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 300), max_size=16))
def test_any_ids_are_decoded_as_by_the_library(pieces, library, ids):
    assert pieces.decode(ids) == library.decode(ids)


def test_sentencepiece_documents(spark, library):
    rng = random.Random(6)
    long = " ".join(rng.choice(["alpha", "straße", "7201", "日本", "x" * 300]) for _ in range(40_000))
    texts = [None, "", " ", "▁", "twice", "twice", long, "a" * 5000, "\n\n  two  spaces\t", "ünï😀code", "<s> </s> <unk>"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string, agrees string")
    got = {r["doc_id"]: r for r in op12.encode_documents(df).collect()}
    assert len(got) == len(rows)
    for i, t, _, _ in rows:
        assert got[i]["ids"] == library.encode(t or "", add_bos=True, add_eos=True) and got[i]["agrees"]
        assert got[i]["decoded"] == library.decode(got[i]["ids"])
    back = {r["doc_id"]: r["text"] for r in op12.decode_documents(op12.encode_documents(df, check=False)).collect()}
    assert back == {i: r["decoded"] for i, r in got.items()}
    for r in op12.digests(df).collect():
        own = got[r["doc_id"]]
        assert r["n_tokens"] == len(own["ids"]) and r["agrees"]
        assert r["ids_sha256"] == hashlib.sha256(np.array(own["ids"], "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(own["decoded"].encode()).hexdigest()
    assert op12.digests(df.limit(0)).count() == 0
    assert op12.decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first()["text"] is None


def test_other_vocabularies_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as model

    proto = model.ModelProto()
    with open(op12.default_model(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = model.TrainerSpec.UNIGRAM
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        op12.Pieces(str(path))


# -- 13 -------------------------------------------------------------------------------------------


def plain_middle(doc_id, text, rate=100, spm_rate=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\né漢😀\r", max_size=200))
def test_skip_list_reaches_every_rank(text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    lanes = op13.SkipList(text.encode())
    assert lanes.n == len(lines)
    for rank in range(len(lines) + 1):
        before = "".join(lines[:rank])
        assert lanes.position(rank) == (len(before), len(before.encode()))


def test_skip_list_of_many_lines():
    text = "".join("é" * (k % 7) + "\n" for k in range(50_000)) + "end"
    lanes = op13.SkipList(text.encode())
    assert lanes.n == 50_001 and 6 <= len(lanes.lanes) <= 12
    lines = text.splitlines(keepends=True)
    for rank in (0, 1, 17, 25_000, 49_999, 50_000, 50_001):
        assert lanes.position(rank)[0] == sum(map(len, lines[:rank]))


def test_fill_in_middle(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab \né漢😀") for _ in range(rng.randrange(200))) for _ in range(80)]
    texts += [None, "", "\n", "\n\n\n", "one line", "has <P> inside", "x\n<M>", "<S", "<\n<\nP>\nS>", "long\n" * 200_000, "w" * 300_000]
    rows = [(i, t, "f", 1) for i, t in enumerate(texts)] + [(3, texts[3], "f", 1), (None, "no\nid\nhere", "f", 1), (None, None, "f", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, FIM string, n int")
    for rate, spm in ((100, 50), (60, 0), (0, 50)):
        out = op13.fill_in_middle(df, rate=rate, spm_rate=spm)
        assert out.columns == ["doc_id", "text", "n", "fim"]
        got = out.select("doc_id", "text", "fim.*", op13.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
        assert len(got) == len(rows)
        for r in got:
            assert tuple(r)[2:7] == plain_middle(r["doc_id"], r["text"], rate, spm)
            assert r["back"] == (r["text"] or "")
        if rate == 100:
            assert {"psm", "spm", "plain"} == {r["form"] for r in got}
    assert op13.fill_in_middle(df.limit(0)).count() == 0
