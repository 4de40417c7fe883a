"""Spark plan shared by the two substring operators: which windows of W tokens also start in a document
with a smaller doc_id.

Documents are dealt into blocks by a hash of the row; the text is shuffled once and read by three
co-grouped passes (Spark reuses the exchange).  A task works on a block part by part, and sends one message
for all of it to each slice, so that a message holds many keys.  Only compressed arrays move:

1. every block names its windows' anchors (an operator's own locally consistent symbols or sampled
   strings), and for each anchor it holds, is told whether another block has it, too;
2. the windows of shared anchors go to the anchor's slice with what is needed to compare them whole;
   there a window is a repeat when an equal one belongs to a smaller doc_id;
3. every block gets the repeated intervals of its documents and cuts them.

Equal windows have equal anchors, so no repeat is missed, and windows are compared by 64-bit names of
their whole content on top of the 48-bit anchor, so nothing else is cut.  An anchor that a block has many
times is sent once, so an anchor in a third of all documents costs one entry a block.  Exact copies of a
whole text are found by hash beforehand; only rows with the smallest doc_id of a text take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, mix, odd_factors, shielded

#: A block's text, and a slice's share of the text; a run of equal windows in a block is sent on once, so a passage
#: of a third of all documents is one entry a block.  Blocks and slices both grow with the input: the larger they
#: are, the fewer messages carry the same keys.
BLOCK_BYTES = 1 << 22
SLICE_BYTES = 1 << 24
LEAST_BLOCKS = 24
#: Text worked on at once within a block, or one text: every byte of it becomes several 64-bit numbers.
PART_BYTES = 1 << 18
#: Rows of a block's result handed to Spark at once.
ROWS_OUT = 256
#: The join that finds exact copies deals each hash out over so many tasks.
COPY_SALTS = 8
#: Entries of the windows' load compared at once in a slice; only whole anchor groups stay together.
COMPARE_ENTRIES = 1 << 18
#: Keys of a slice counted at once.
ANSWER_KEYS = 1 << 17

#: An anchor with more windows than this in all blocks is dealt out window by window.
HOT_WINDOWS = 1 << 17

MESSAGE = "_blk int, kind int, x long, y long, data binary"
MAIL = "slice int, _blk int, data binary"
COPY, SHARED, SPANS = 0, 1, 2
# in place of a head's length: spans that need no comparing, and single windows of hot anchors
KNOWN, WINDOWS = b"\xff\xff\xff\xff", b"\xfe\xff\xff\xff"

POWER = odd_factors(3)[2]
INVERSE = np.uint64(pow(int(POWER), -1, 1 << 64))


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one compressed string, byte by byte across each array (high bytes shrink away)."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a, dtype="<u8").view(np.uint8).reshape(-1, 8).T
        data = zstandard.compress(planes.tobytes(), 1)
        parts.append(len(data).to_bytes(4, "little") + data)
    return b"".join(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        raw = zstandard.decompress(data[at + 4 : at + 4 + n])
        planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
        out.append(np.ascontiguousarray(planes.T).view("<u8").ravel())
        at += 4 + n
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def window_runs(names: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, count) of the maximal runs of valid windows with one name."""
    same = np.zeros(len(names), bool)
    same[1:] = valid[1:] & valid[:-1] & (names[1:] == names[:-1])
    first = valid & ~same
    last = valid.copy()
    last[:-1] &= ~same[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) - starts + 1


def window_mask(bounds: np.ndarray, use: np.ndarray, width: int) -> np.ndarray:
    """Which positions start a window inside one used document."""
    n = int(bounds[-1])
    edge = np.zeros(n + 1, np.int8)
    own = use & (np.diff(bounds) >= width)
    edge[bounds[:-1][own]] += 1
    edge[bounds[1:][own] - width + 1] -= 1
    return np.cumsum(edge[:n], dtype=np.int8).astype(bool)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers start, start + 1, ... of every range, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    jump = np.ones(total, np.int64)
    ends = np.cumsum(counts)
    jump[0] = starts[0]
    jump[ends[:-1]] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(jump)


def cut(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values (none negative) begin and end."""
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return first, np.append(first[1:], len(values))[: len(first)]


class RangeNames:
    """64-bit names of any ranges of a sequence of 64-bit values, from running sums of a polynomial."""

    def __init__(self, values: np.ndarray):
        power = np.full(len(values), POWER, np.uint64)
        back = np.full(len(values) + 1, INVERSE, np.uint64)
        power[:1] = back[:1] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(power), dtype=np.uint64)])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]


def give_back() -> None:
    """Memory of the groups before that Arrow still holds goes back to the system: a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()


class Block:
    """The documents of a block in a fixed order, whatever order they came in."""

    def __init__(self, spec, docs: pa.Table, mail: pa.Table):
        give_back()
        raw = docs["text"].cast(pa.binary()).to_pylist()
        ids = docs["doc_id"].to_pylist()
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, raw[i] is None, raw[i] or b""))
        self.ids = [ids[i] for i in self.order]
        self.text = [raw[i] or b"" for i in self.order]
        hashes = docs["_th"].to_pylist()
        kinds = mail["kind"].to_pylist()
        copied = {(x, y) for k, x, y in zip(kinds, mail["x"].to_pylist(), mail["y"].to_pylist(), strict=True) if k == COPY}
        self.copy = np.array([(ids[i], hashes[i]) in copied for i in self.order], bool)
        self.use = ~self.copy & np.array([x is not None for x in self.ids], bool)
        self.mail = [d for k, d in zip(kinds, mail["data"].to_pylist(), strict=True) if k != COPY]
        self.tokens, self.bounds = spec.load(self.text)
        # documents first, last + 1 of each part
        used = np.cumsum([0, *map(len, self.text)])[:-1] // PART_BYTES
        self.parts = list(zip(*cut(used), strict=True))

    def each(self):
        """(first document, last + 1, first token, last + 1) of every part."""
        for a, z in self.parts:
            yield a, z, int(self.bounds[a]), int(self.bounds[z])

    def segments(self, spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, start, count) of the runs of windows with one anchor."""
        found = [
            (name, start + p, count)
            for a, z, p, q in self.each()
            for name, start, count in spec.segments(self.tokens[p:q], self.bounds[a : z + 1] - p, self.use[a:z])
        ]
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        name, start, count = (np.concatenate(x) for x in zip(*found, strict=True))
        return mix(name) >> np.uint64(16), start, count

    def doc_of(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, start, "right") - 1

    def names(self, spec, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Names of ranges, each within one document; ``start`` in any order."""
        out = np.empty(len(start), np.uint64)
        order = np.argsort(start, kind="stable")
        for _, _, p, q in self.each():
            own = order[slice(*np.searchsorted(start, [p, q], sorter=order))]
            if len(own):
                out[own] = RangeNames(spec.values(self.tokens[p:q])).of(start[own] - p, length[own])
        return out

    def prepared(self, spec) -> np.ndarray:
        """What the spec's payload is taken from, at every position that starts a window."""
        out = [spec.prepare(self.tokens[p:q]) for _, _, p, q in self.each()]
        return np.concatenate([np.pad(x, (0, q - p - len(x))) for x, (_, _, p, q) in zip(out, self.each(), strict=True)] or [self.tokens])


def _send_keys(spec, slices: int):
    def send(docs: pa.Table, mail: pa.Table) -> pa.Table:
        key, _, count = Block(spec, docs, mail).segments(spec)  # keys of a whole block: 16 bytes a segment
        keys, which = np.unique(key, return_inverse=True)
        windows = np.bincount(which, count, len(keys)).astype(np.int64)
        blk = docs["_blk"][0].as_py() if len(docs) else 0
        part = (keys % np.uint64(slices)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        keys, windows, part = keys[order], windows[order], part[order]
        cuts, ends = cut(part)
        data = [pack(np.diff(keys[a:b], prepend=np.uint64(0)), windows[a:b]) for a, b in zip(cuts, ends, strict=True)]
        return pa.table(
            {
                "slice": pa.array(part[cuts], pa.int32()),
                "_blk": pa.array([blk] * len(data), pa.int32()),
                "data": pa.array(data, pa.binary()),
            }
        )

    return send


def _messages(blks: list[int], kind: int, data: list[bytes]) -> pa.Table:
    n, none = len(blks), pa.nulls(len(blks), pa.int64())
    return pa.table({"_blk": pa.array(blks, pa.int32()), "kind": pa.array([kind] * n, pa.int32()), "x": none, "y": none, "data": pa.array(data, pa.binary())})


def _answer_keys(mail: pa.Table) -> pa.Table:
    give_back()
    blks, lists, counts = mail["_blk"].to_pylist(), [], []
    for data in mail["data"]:
        x, n = unpack(data.as_py())
        lists.append(np.cumsum(x, dtype=np.uint64))
        counts.append(n.view(np.int64))
    told = [([], []) for _ in blks]
    # keys are hashes of 48 bits, so ranges of equal width hold about as many
    steps = sum(map(len, lists)) // ANSWER_KEYS + 1
    edges = np.array([(k << 48) // steps for k in range(steps + 1)], np.uint64)
    places = [np.searchsorted(x, edges) for x in lists]
    for k in range(steps):
        own = [x[at[k] : at[k + 1]] for x, at in zip(lists, places, strict=True)]
        every = np.concatenate(own)
        order = np.argsort(every)
        every, windows = every[order], np.concatenate([n[at[k] : at[k + 1]] for n, at in zip(counts, places, strict=True)])[order]
        first = np.flatnonzero(np.diff(every, prepend=every[:1] + np.uint64(1)))
        again = every[first][np.diff([*first, len(every)]) > 1]
        if not len(again):
            continue
        hot = every[first][np.add.reduceat(windows, first) > HOT_WINDOWS]
        for x, (found, heat) in zip(own, told, strict=True):
            x = x[np.isin(x, again, assume_unique=True)]
            found.append(x)
            heat.append(np.isin(x, hot, assume_unique=True))
    told = [(b, np.concatenate(found), np.concatenate(heat)) for b, (found, heat) in zip(blks, told, strict=True) if found]
    told = [(b, pack(np.diff(x, prepend=np.uint64(0)), heat)) for b, x, heat in told if len(x)]
    return _messages([b for b, _ in told], SHARED, [d for _, d in told])


def _name_windows(spec, load: np.ndarray, size: np.ndarray, key: np.ndarray, count: np.ndarray) -> np.ndarray:
    return mix(spec.names(load, size, count) ^ mix(np.repeat(key, count), 1))


def _joined(hit: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of the runs of hits within a segment."""
    joined = np.zeros(len(hit), bool)
    joined[1:] = hit[1:] & hit[:-1] & (segment[1:] == segment[:-1])
    last = hit.copy()
    last[:-1] &= ~joined[1:]
    return np.flatnonzero(hit & ~joined), np.flatnonzero(last)


def _lowest(order: np.ndarray, fresh: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every entry the smallest id of its group; ``order`` sorts the entries, ``fresh`` begins the groups."""
    out = np.empty(len(order), np.int64)
    if len(order):
        out[order] = np.repeat(np.minimum.reduceat(ids[order], fresh), np.diff([*fresh, len(order)]))
    return out


def _send_segments(spec, slices: int):
    def send(docs: pa.Table, mail: pa.Table) -> pa.Table:
        block = Block(spec, docs, mail)
        key, start, count = block.segments(spec)
        doc = block.doc_of(start)
        # shared: another block has the key, or two documents of this one
        answers = [unpack(d) for d in block.mail]
        told = [np.cumsum(x, dtype=np.uint64) for x, _ in answers]
        hot = np.concatenate([x[h.astype(bool)] for x, (_, h) in zip(told, answers, strict=True)] or [key[:0]])
        order = np.lexsort((doc, key))
        k, d = key[order], doc[order]
        near = k[1:][(k[1:] == k[:-1]) & (d[1:] != d[:-1])]
        shared = np.unique(np.concatenate([*told, near]))
        keep = np.flatnonzero(np.isin(key, shared))
        key, start, count, doc = key[keep], start[keep], count[keep], doc[keep]
        # Of equal segments in this block only the smallest document's is sent on; the others repeat it.  So a
        # passage of a third of all documents is one entry a block.
        ids = np.array([x or 0 for x in block.ids], np.int64)
        whole = block.prepared(spec)
        name = mix(block.names(spec, start, count + spec.width - 1) ^ mix(key) ^ count.astype(np.uint64))
        order = np.lexsort((ids[doc], name))
        head = np.concatenate([[True], np.diff(name[order]) != 0]) if len(order) else np.zeros(0, bool)
        low = np.empty(len(order), np.int64)
        low[order] = ids[doc][order][np.flatnonzero(head)][np.cumsum(head) - 1]
        again = ids[doc] > low
        begin = start - block.bounds[doc]
        blk = docs["_blk"][0].as_py() if len(docs) else 0
        known = [(doc[again], begin[again], count[again] + spec.width - 1)]
        key, start, count, doc = key[~again], start[~again], count[~again], doc[~again]
        to, data = [], []
        apart = np.isin(key, hot)
        if apart.any():
            # single windows of hot anchors; of equal ones in this block only the smallest document's
            k, at, n, d = key[apart], start[apart], count[apart], doc[apart]
            load, size = spec.unload(spec.payload(whole, at, n), n)
            names, place = _name_windows(spec, load, size, k, n), ranges(at, n)
            segment = np.repeat(np.arange(len(k)), n)
            k, d = k[segment], d[segment]
            place = place - block.bounds[d]
            order = np.lexsort((names, k))
            fresh = np.flatnonzero(np.append(True, (np.diff(names[order]) != 0) | (np.diff(k[order]) != 0)))
            hit = ids[d] > _lowest(order, fresh, ids[d])
            head, tail = _joined(hit, segment)
            known.append((d[head], place[head], place[tail] + spec.width - place[head]))
            k, names, d, place = k[~hit], names[~hit], d[~hit], place[~hit]
            part = (names % np.uint64(slices)).astype(np.int64)
            order = np.lexsort((place, d, k, part))
            k, names, d, place, part = k[order], names[order], d[order], place[order], part[order]
            cuts, ends = cut(part)
            to += part[cuts].tolist()
            data += [WINDOWS + pack(np.diff(k[a:b], prepend=np.uint64(0)), names[a:b], ids[d[a:b]], d[a:b], place[a:b]) for a, b in zip(cuts, ends, strict=True)]
            key, start, count, doc = key[~apart], start[~apart], count[~apart], doc[~apart]
        part = (key % np.uint64(slices)).astype(np.int64)
        order = np.lexsort((key, part))
        key, start, count, doc, part = key[order], start[order], count[order], doc[order], part[order]
        cuts, ends = cut(part)
        to += part[cuts].tolist()
        for a, b in zip(cuts, ends, strict=True):
            cols = (np.diff(key[a:b], prepend=np.uint64(0)), ids[doc[a:b]], doc[a:b], start[a:b] - block.bounds[doc[a:b]], count[a:b])
            head = pack(*cols)
            data.append(len(head).to_bytes(4, "little") + head + spec.payload(whole, start[a:b], count[a:b]))
        known = [np.concatenate(x) for x in zip(*known, strict=True)]
        if len(known[0]):  # passed on by any slice as it is
            to.append(blk % slices)
            data.append(KNOWN + pack(*known))
        return pa.table({"slice": pa.array(to, pa.int32()), "_blk": pa.array([blk] * len(data), pa.int32()), "data": pa.array(data, pa.binary())})

    return send


def _confirm_windows(spec, rows: list[tuple]) -> tuple:
    """Spans of the repeated ones of single windows."""
    key, names, ids, doc, place, blk = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((names, key))
    fresh = np.flatnonzero(np.append(True, (np.diff(names[order]) != 0) | (np.diff(key[order]) != 0)))
    hit = ids > _lowest(order, fresh, ids)
    return blk[hit], doc[hit], place[hit], place[hit] + spec.width


def _confirm(spec):
    def confirm(mail: pa.Table) -> pa.Table:
        give_back()
        rows, loads, known, single = [], [], [], []
        blks = np.array(mail["_blk"].to_pylist(), np.int64)
        for k, data in enumerate(mail["data"].to_pylist()):
            if data[:4] == KNOWN:
                known.append((int(blks[k]), data[4:]))
                continue
            if data[:4] == WINDOWS:
                key, names, ids, doc, place = unpack(data[4:])
                single.append((np.cumsum(key, dtype=np.uint64), names, ids.view(np.int64), doc.view(np.int64), place.view(np.int64), np.full(len(key), blks[k])))
                continue
            n = int.from_bytes(data[:4], "little")
            key, ids, doc, start, count = unpack(data[4 : 4 + n])
            rows.append((np.cumsum(key, dtype=np.uint64), ids.view(np.int64), doc.view(np.int64), start.view(np.int64), count.view(np.int64), np.full(len(key), blks[k])))
            loads.append(spec.unload(data[4 + n :], count.view(np.int64)))
        out = [_confirm_windows(spec, single)] if single else []
        if rows:
            out += compare(rows, loads)
        if not out:
            return _messages([b for b, _ in known], SPANS, [d for _, d in known])
        blk, doc, begin, end = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((begin, doc, blk))
        blk, doc, begin, end = blk[order], doc[order], begin[order], end[order]
        cuts, ends = cut(blk)
        data = [pack(doc[a:b], begin[a:b], end[a:b] - begin[a:b]) for a, b in zip(cuts, ends, strict=True)]
        return _messages(blk[cuts].tolist() + [b for b, _ in known], SPANS, data + [d for _, d in known])

    def compare(rows: list[tuple], loads: list[tuple]) -> list[tuple]:
        key, ids, doc, start, count, blk = (np.concatenate(x) for x in zip(*rows, strict=True))
        load = np.concatenate([x for x, _ in loads])
        size = np.concatenate([x for _, x in loads])  # entries of the load per segment
        rows.clear()  # held once from here on
        loads.clear()
        at = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order], prepend=key[order][:1] + np.uint64(1)))  # first of each key
        batch = np.cumsum(size[order])[new] // COMPARE_ENTRIES
        edges = [*new[np.flatnonzero(np.diff(batch, prepend=-1))], len(order)]
        out: list[tuple] = []
        for a, b in zip(edges, edges[1:], strict=False):
            own = order[a:b]
            names = _name_windows(spec, load[ranges(at[own], size[own])], size[own], key[own], count[own])
            whose = np.repeat(ids[own], count[own])
            by = np.argsort(names)
            hit = whose > _lowest(by, np.flatnonzero(np.diff(names[by], prepend=names[by][:1] + np.uint64(1))), whose)
            segment = np.repeat(np.arange(len(own)), count[own])
            place = ranges(start[own], count[own])
            head, tail = _joined(hit, segment)
            out.append((blk[own][segment[head]], doc[own][segment[head]], place[head], place[tail] + spec.width))
        return out

    return confirm


def _finish(spec, columns: list[str], schema: pa.Schema):
    def finish(docs: pa.Table, mail: pa.Table) -> pa.Table:
        block = Block(spec, docs, mail)
        spans = [tuple(x.view(np.int64) for x in unpack(data)) for data in block.mail]
        doc, begin, size = (np.concatenate(x) for x in zip(*spans, strict=True)) if spans else (np.zeros(0, np.int64),) * 3
        order = np.argsort(doc, kind="stable")
        doc, begin, size = doc[order], begin[order], size[order]
        made = []
        for a, z, p, q in block.each():
            own = slice(*np.searchsorted(doc, [a, z]))
            first = block.bounds[doc[own]] - p + begin[own]
            edge = np.zeros(q - p + 1, np.int32)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + size[own], -1)
            cover = np.cumsum(edge[:-1]) > 0
            for i in range(a, z):
                at, end = int(block.bounds[i]), int(block.bounds[i + 1])
                if block.copy[i] and end - at >= spec.width:
                    cover[at - p : end - p] = True
                made.append(spec.result(block.text[i], block.tokens, at, end, cover[at - p : end - p]))
        out = docs.select(columns).take(pa.array(block.order, pa.int64()))
        for name, values in zip(spec.results, zip(*made, strict=True) if made else [()] * len(spec.results), strict=True):
            out = out.append_column(name, pa.array(values, schema.field(name).type))
        return pa.Table.from_batches(out.cast(schema).to_batches(ROWS_OUT), schema)

    return finish


def find_repeats(docs: DataFrame, spec) -> DataFrame:
    """``docs`` with the spec's result columns; ``spec`` gives the tokens, anchors and results.

    A null text is empty and a null doc_id is neither smaller nor larger than another: such rows keep all
    their tokens and take none from others.  Rows with one doc_id never take from each other, so repeated rows are
    treated alike.  Whole texts of any length are worked on; a block holds about BLOCK_BYTES and at most one part
    (PART_BYTES, or one longer text) of it is expanded at once.
    An empty table gives no rows.  Other columns stay; one named like a result (in any case) is replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    replaced = {c.lower() for c in spec.results}
    docs, names = shielded(docs.select(*[c for c in docs.columns if c.lower() not in replaced]), ["_th", "_blk"])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, slices = (max(LEAST_BLOCKS, size // n + 1) for n in (BLOCK_BYTES, SLICE_BYTES))
    columns = docs.columns
    th = F.xxhash64("text")
    own = docs.select(*columns, th.alias("_th"), F.pmod(F.xxhash64("doc_id", th), F.lit(blocks)).cast("int").alias("_blk"))
    texts = own.where("doc_id is not null and text is not null").select("doc_id", "_th", "_blk", F.md5("text").alias("m"))
    lowest = texts.groupBy("m").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    # every hash's smallest doc_id stands under each salt, so a text in a third of all rows is not one task's
    lowest = lowest.select("*", F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(COPY_SALTS)).cast("int")
    copies = checkpointed(
        texts.withColumn("salt", salt)
        .join(lowest, ["m", "salt"])
        .where("doc_id > lo")
        .select("_blk", F.lit(COPY).alias("kind"), F.col("doc_id").cast("long").alias("x"), F.col("_th").alias("y"), F.lit(None).cast("binary").alias("data"))
    )

    def with_mail(mail: DataFrame):
        return own.groupBy("_blk").cogroup(mail.groupBy("_blk"))

    keys = with_mail(copies).applyInArrow(_send_keys(spec, slices), MAIL)
    shared = keys.groupBy("slice").applyInArrow(_answer_keys, MESSAGE)
    segments = with_mail(copies.unionByName(shared)).applyInArrow(_send_segments(spec, slices), MAIL)
    spans = segments.groupBy("slice").applyInArrow(_confirm(spec), MESSAGE)
    schema = StructType([docs.schema[c] for c in columns])
    for name, kind in spec.results.items():
        schema = schema.add(name, kind)
    done = with_mail(copies.unionByName(spans)).applyInArrow(_finish(spec, columns, to_arrow_schema(schema, prefers_large_types=False)), schema)
    return done.select(*[F.col(now).alias(c) for c, now in names.items()], *spec.results)
