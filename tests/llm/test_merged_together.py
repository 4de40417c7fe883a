"""op12: new segments of one length are merged together, with the results of one at a time."""

from __future__ import annotations

import random

import pytest
from docweave.llm import op12_sentencepiece as op12


@pytest.fixture(scope="module")
def pieces():
    return op12.Pieces(op12.default_model())


def test_segments_merged_together_as_alone(pieces):
    rng, known = random.Random(4), list(pieces.ids)
    by_length = {}
    for _ in range(6000):
        text = "".join(rng.choice(known) for _ in range(rng.randint(1, 5))) + rng.choice(["", "", "é😀", "あ", "▁▁"])
        by_length.setdefault(len(text), []).append(text)
    by_length |= {n: [*by_length.get(n, []), "a" * n, op12.SPACE * n, "~" * n] for n in range(1, 33)}
    for segments in by_length.values():
        assert pieces.merge_many(segments) == [pieces.merge(s) for s in segments]


def test_texts_leave_few_segments_to_be_merged_alone(pieces, monkeypatch):
    rng, alone = random.Random(5), []
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9))) for _ in range(6000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 300))) + rng.choice(["", "\n", " 😀~", "  "]) for _ in range(200)]
    want = [op12._library(op12.default_model()).encode(t, add_bos=True, add_eos=True) for t in texts]
    merge_short = op12.Pieces.merge_short
    monkeypatch.setattr(op12.Pieces, "merge_short", lambda self, s: alone.append(s) or merge_short(self, s))
    monkeypatch.setattr(op12, "MEMO_SIZE", 2500)  # outgrown more than once
    monkeypatch.setattr(op12, "GROUP_CHARS", 20_000)
    got = list(pieces.packed_all(texts))
    assert [op12.np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert len(alone) < 3000 and len(pieces) <= 2500
    assert [pieces.decode_packed(x) for x in got] == [op12._library(op12.default_model()).decode(x) for x in want]
