"""op4: pairs of long documents that share a passage only are told apart before their sets are moved."""

from __future__ import annotations

import numpy as np
from docweave.llm import op04_ngram_jaccard as op04


def _text(rng, n: int) -> list[str]:
    return [f"w{x}" for x in rng.integers(0, 1 << 40, n)]


def test_unrelated_long_sets_are_not_verified(spark, monkeypatch):
    rng = np.random.default_rng(11)
    # each two documents share a third of their words, so that prefixes meet
    passage = {(i, j): _text(rng, 2000) for i in range(4) for j in range(i + 1, 4)}
    texts = [[w for pair, own in passage.items() if i in pair for w in own] for i in range(4)]
    near = list(texts[0])
    near[2000] = "changed"
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, near, _text(rng, 60)])]
    rows += [(10, rows[5][1]), (11, "a b c"), (12, None)]
    sent, verified = [], op04.verified

    def counted(pairs, *rest):
        sent.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return verified(pairs, *rest)

    monkeypatch.setattr(op04, "verified", counted)
    got = op04.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0, 5: 5, 10: 5, 11: 11, 12: 12}
    assert sent == [(0, 4)]


def test_bucket_counts_differ_by_the_symmetric_difference_at_most():
    rng = np.random.default_rng(5)
    for n in (10, 4000, 300_000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[: n - n // 8], rng.integers(0, 1 << 63, n // 5, dtype=np.uint64)])
        differ = len(np.setxor1d(a, b))
        assert np.abs(op04.bucket_counts(a).astype(int) - op04.bucket_counts(b).astype(int)).sum() <= differ
