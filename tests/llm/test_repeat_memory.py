"""What the passes of the repeat search hold at once follows parts and ranges, not whole blocks and slices."""

import tracemalloc

import numpy as np
import pyarrow as pa

from docweave.llm import op06_suffix_array_dedup as op6
from docweave.llm import repeats


def _keys_mail(rng, blocks: int, keys: int) -> tuple[pa.Table, list]:
    """Keys of one slice as the blocks send them; a third of them from a small common pool."""
    pool = rng.integers(0, 1 << 48, keys, dtype=np.uint64)
    own, data = [], []
    for _ in range(blocks):
        x = np.unique(np.concatenate([rng.integers(0, 1 << 48, keys - keys // 3, dtype=np.uint64), rng.choice(pool, keys // 3)]))
        n = rng.integers(1, 40, len(x))
        own.append((x, n))
        data.append(repeats.pack(np.diff(x, prepend=np.uint64(0)), n.astype(np.uint64)))
    return pa.table({"_blk": pa.array(range(blocks), pa.int32()), "data": pa.array(data, pa.binary())}), own


def _peak(run) -> tuple[float, object]:
    run()  # what is loaded and remembered the first time does not count
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1], out
    finally:
        tracemalloc.stop()


def test_keys_of_a_slice_are_counted_range_by_range():
    mail, own = _keys_mail(np.random.default_rng(1), 16, 60_000)
    size = sum(x.nbytes + n.nbytes for x, n in own)
    peak, _ = _peak(lambda: repeats._answer_keys(mail))
    assert peak < 2.5 * size, (peak, size)


def test_ranges_of_keys_give_the_same_answers(monkeypatch):
    monkeypatch.setattr(repeats, "HOT_WINDOWS", 60)
    mail, own = _keys_mail(np.random.default_rng(2), 7, 900)
    mail = pa.concat_tables([mail, pa.table({"_blk": pa.array([7], pa.int32()), "data": pa.array([repeats.pack(np.array([(1 << 48) - 1]), np.array([3]))], pa.binary())})])
    own.append((np.array([(1 << 48) - 1], np.uint64), np.array([3])))
    # a key at either end of all ranges, in two blocks
    mail = pa.concat_tables([mail, pa.table({"_blk": pa.array([8, 9], pa.int32()), "data": pa.array([repeats.pack(np.array([0, (1 << 48) - 1]), np.array([1, 1]))] * 2, pa.binary())})])
    own += [(np.array([0, (1 << 48) - 1], np.uint64), np.array([1, 1]))] * 2
    total: dict[int, list[int]] = {}
    for x, n in own:
        for key, k in zip(x.tolist(), n.tolist(), strict=True):
            total.setdefault(key, []).append(k)
    plain = {
        b: [(key, sum(total[key]) > repeats.HOT_WINDOWS) for key in x.tolist() if len(total[key]) > 1] for b, (x, _) in enumerate(own)
    }
    plain = {b: found for b, found in plain.items() if found}
    assert any(h for found in plain.values() for _, h in found)
    for keys in (repeats.ANSWER_KEYS, 1000, 1):
        monkeypatch.setattr(repeats, "ANSWER_KEYS", keys)
        told = repeats._answer_keys(mail)
        got = {}
        for b, data in zip(told["_blk"].to_pylist(), told["data"].to_pylist(), strict=True):
            x, h = repeats.unpack(data)
            got[b] = list(zip(np.cumsum(x, dtype=np.uint64).tolist(), map(bool, h.tolist()), strict=True))
        assert got == plain


def _no_mail() -> pa.Table:
    return pa.table({k: pa.array([], t) for k, t in (("_blk", pa.int32()), ("kind", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("data", pa.binary()))})


def _documents(bounds: list[int]) -> pa.Table:
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, n, np.uint8).tobytes().decode() for n in bounds]
    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "_th": pa.array([0] * len(texts), pa.int64()), "_blk": pa.array([0] * len(texts), pa.int32())})


def test_a_block_is_expanded_in_small_parts():
    """A block of 4 MB, as find_repeats deals them, of short texts or one long text."""
    spec = op6.DigestWindows()
    for lengths in ([2000] * 2000, [4_000_000]):
        docs = _documents(lengths)
        for run in (repeats._send_keys(spec, 31), repeats._send_segments(spec, 31)):
            peak, _ = _peak(lambda run=run, docs=docs: run(docs, _no_mail()))
            assert peak < 30e6, (lengths[:1], peak)
