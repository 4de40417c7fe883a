"""op12: short segments are merged by a list of adjacent pairs, with the results of the numbered agenda."""

from __future__ import annotations

import random

from docweave.llm import op12_sentencepiece as op12


def test_short_segments_skip_the_numbered_agenda(monkeypatch):
    pieces = op12.Pieces(op12.default_model())
    rng, known = random.Random(3), list(pieces.ids)
    texts = ["", "a", "aaaaaa", "▁▁▁▁", "😀é", "~"]
    for _ in range(3000):
        text = "".join(rng.choice(known) for _ in range(rng.randint(1, 4)))
        texts.append(text[: rng.randint(1, len(text))] + rng.choice(["", "", "é😀", "あ", "▁▁"]))
    want = [pieces.merge(t) for t in texts]
    assert [pieces.merge_short(t) for t in texts] == want

    def none(self, segment):
        raise AssertionError(segment)

    monkeypatch.setattr(op12.Pieces, "merge", none)
    assert pieces.packed("An unheardofword, and zxqvk.") and len(pieces) > 3
