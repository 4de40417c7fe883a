"""Embedding near-dedup: tiles of neighbouring vectors that meet without being copied.

Two unit vectors of cosine c are arccos(c) apart.  Vectors are dealt to the nearest of some pivots and packed, a
few tens of thousands in a row, into tiles.  Tiles are written once and meet pairwise in a join that reads them from
there, so what is written grows with the vectors, not with their pairs.  Where two tiles meet, a group of neighbours is
passed over by all vectors whose angle to its centre rules out a link; the others are told apart by their leading
coordinates on principal axes, and what is left is verified exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_bytes, connected_components, read, staged

MIN_COSINE = 0.95
BLOCKS = 8
#: Leading coordinates of each block by which pairs are told apart before they are verified.
GRID_DIMS = 2
#: Vectors, and bytes of them, in a tile at most.  Each pair of tiles goes to a Python worker once, so small tiles mean
#: more reading; two tiles and what they meet with are held by a task.  A smaller table is cut into TILES tiles, but
#: not below LEAST_TILE vectors.
TILE = 65536
TILE_BYTES = 16 << 20
TILES = 16
LEAST_TILE = 2048
#: Vectors for each pivot, and pivots (and their components) at most.
CELL = 128
PIVOTS = 8192
PIVOT_NUMBERS = 1 << 21
#: Vectors around a centre, and of them such as are passed over or met together; centres looked at together.
NEIGHBOURS = 256
GROUP = 32
HOODS_AT_ONCE = 32
#: Ranges of tiles that a task holds one of, while another streams by: this many, or more of RANGE_BYTES each.
RANGES = 64
RANGE_BYTES = 64 << 20
#: Bytes of prepared tiles that a task keeps for their next meeting.
KEPT_BYTES = 64 << 20
#: Pairs scored at once, pairs connected at once, and components of pairs verified at once, so that a group of near
#: copies needs no more memory than its vectors.
SCORES_AT_ONCE = 1 << 18
PAIRS_AT_ONCE = 1 << 16
NUMBERS_AT_ONCE = 1 << 22
ROWS_AT_ONCE = 4096
#: Rounded coordinates are whole multiples of this: a unit vector's squared length is then at most some 2^22 squared
#: steps, so 32-bit floats hold sums of their products exactly, and every task finds the same ones.
STEP = 2.0**-11


class Subspaces:
    """A rotation onto principal axes and consecutive blocks of them, each with some of the widest.  The leading
    coordinates of all blocks and the length of the rest bound a cosine from above."""

    def __init__(self, moments: np.ndarray, count: int, blocks: int, grid: int, min_cosine: float):
        dims = len(moments)
        values, axes = np.linalg.eigh(moments / max(count, 1))
        top = np.argsort(-values, kind="stable")
        # axes dealt in turn, so every block has some of the widest
        parts = [np.arange(k, dims, blocks) for k in range(min(blocks, dims))]
        self.turn = axes[:, top[np.concatenate(parts)]] / STEP
        ends = np.cumsum([0, *map(len, parts)])
        leading = np.zeros(dims, bool)
        for begin, part in zip(ends, parts, strict=False):
            leading[begin : begin + min(grid, len(part))] = True
        self.leading, self.rest = np.flatnonzero(leading), np.flatnonzero(~leading)
        self.min_cosine = min_cosine
        self.reach = float(np.arccos(np.clip(min_cosine, -1.0, 1.0)))
        #: How far a product of two unit vectors in 32 bits is off, and an angle found from it.
        self.blur = (dims + 8) * 2.0**-23
        self.angle_blur = 2.0 * math.sqrt(2.0 * self.blur)
        self.sure, self.never = np.float32(min_cosine + self.blur), np.float32(min_cosine - self.blur)
        # half a step in each leading coordinate of both vectors, and what 32 bits lose
        self.least_score = np.float32(min_cosine - STEP * math.sqrt(len(self.leading)) - 2 * self.blur)

    def steps(self, unit: np.ndarray) -> np.ndarray:
        return np.rint(unit.astype(np.float64) @ self.turn).astype(np.int16)

    def short(self, unit: np.ndarray) -> np.ndarray:
        """Leading coordinates and the length of the rest.  The product of two rows is at least their vectors'
        cosine, but for what ``least_score`` allows."""
        at = self.steps(unit).astype(np.float32) * np.float32(STEP)
        rest = at[:, self.rest]
        length = np.sqrt((rest * rest).sum(1, keepdims=True)) + np.float32(0.5 * STEP * math.sqrt(len(self.rest)))
        return np.ascontiguousarray(np.hstack([at[:, self.leading], length]))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows over their lengths.  They are scaled by a power of two first, so that no square overflows or vanishes
    and nothing else is rounded differently."""
    _, exponent = np.frexp(np.abs(vectors).max(1, keepdims=True, initial=0.0))
    vectors = np.ldexp(vectors, -exponent)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def _stored_kind(vectors: DataFrame) -> str:
    """How a component travels: as the column has it, in 32 or 64 bits."""
    return "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"


def _digest(embedding: Column) -> Column:
    return F.xxhash64(embedding)


def _pivots(rows: DataFrame, dims: int, n: int) -> np.ndarray:
    """Steps of some of the vectors, by their hash."""
    k = max(1, min(n // CELL, PIVOTS, PIVOT_NUMBERS // dims))
    if k == 1:
        return np.zeros((1, dims), np.float32)
    some = rows.where(F.pmod("h", F.lit(n // k)) == 0).groupBy("embedding").agg(F.count("*")).select("embedding")
    found = np.array([r["embedding"] for r in some.collect()], np.float64).reshape(-1, dims)
    return _plain_steps(found) if len(found) else np.zeros((1, dims), np.float32)


def _plain_steps(vectors: np.ndarray) -> np.ndarray:
    return np.rint(unit_rows(vectors) / STEP).astype(np.float32)


def _tile_rows(n: int, dims: int, kind: str) -> int:
    most = max(1, min(TILE, TILE_BYTES // (dims * np.dtype(kind).itemsize)))
    return min(most, max(LEAST_TILE, -(-4 * n // (3 * TILES))))


def _tiles(rows: DataFrame, dims: int, n: int) -> DataFrame:
    """Equal vectors as one class, with its smallest vec_id and its size, and classes of one neighbourhood side by
    side, packed into tiles."""
    spark, kind = rows.sparkSession, _stored_kind(rows)
    pivots = spark.sparkContext.broadcast(_pivots(rows, dims, n))
    size = _tile_rows(n, dims, kind)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cell (nearest pivot) and how near that is, the same in any task.  Equal vectors of a batch leave as one row."""
        columns = np.ascontiguousarray(pivots.value.T)
        at_once = max(1, (1 << 20) // columns.shape[1])
        for batch in batches:
            x = _matrix(batch["embedding"], dims)
            if not len(x):
                continue
            _, first, which = np.unique(x.view(np.dtype((np.void, 8 * dims))).ravel(), return_index=True, return_inverse=True)
            low = np.full(len(first), np.iinfo(np.int64).max)
            np.minimum.at(low, which, batch["vec_id"].to_numpy())
            steps, cell, near = _plain_steps(x[first]), [], []
            for at in range(0, len(first), at_once):
                dots = steps[at : at + at_once] @ columns
                cell.append(dots.argmax(1))
                near.append(dots.max(1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(cell), pa.int32()),
                    pa.array(np.concatenate(near).astype(np.int32)),
                    batch["h"].take(pa.array(first)),
                    pa.array(low),
                    pa.array(np.bincount(which)),
                    batch["embedding"].take(pa.array(first)),
                ],
                ["cell", "near", "h", "vec_id", "members", "embedding"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], TaskContext.get().partitionId() << 32

        def tile(table: pa.Table) -> pa.RecordBatch:
            raw = _matrix(table["embedding"].combine_chunks(), dims).astype(kind)
            order, hood, angle = _hoods(table["cell"].to_numpy(), raw)
            numbers = [table[c].to_numpy().astype(np.int64)[order] for c in ("vec_id", "members", "h")]
            packed = [pa.array([x.tobytes()], pa.binary()) for x in (hood.astype(np.int64), angle, *numbers, raw[order])]
            return pa.RecordBatch.from_arrays([pa.array([name]), *packed], ["tile", "hood", "angle", "vec_id", "members", "h", "raw"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                yield tile(table.slice(0, size))
                held, name = table.slice(size).to_batches(), name + 1
        if sum(b.num_rows for b in held):
            yield tile(pa.Table.from_batches(held))

    celled = rows.mapInArrow(deal, f"cell int, near int, h long, vec_id long, members long, embedding {rows.schema['embedding'].dataType.simpleString()}")
    # ranges of three quarters of a tile, as they are not all alike; a class is within one: its cell and hash are the
    # same in every row
    dealt = celled.repartitionByRange(-(-4 * n // (3 * size)), "cell", "h").groupBy("cell", "near", "h", "embedding")
    classes = dealt.agg(F.min("vec_id").alias("vec_id"), F.sum("members").alias("members")).sortWithinPartitions("cell", "near")
    return staged(classes.mapInArrow(pack, "tile long, hood binary, angle binary, vec_id binary, members binary, h binary, raw binary"))


def _unpacked(tiles: DataFrame, dims: int, embedding: str | None = None) -> DataFrame:
    """(h, vec_id, members) of the classes, on request with the embedding of that type."""
    kind = "<f4" if embedding == "array<float>" else "<f8"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                columns = [pa.array(np.frombuffer(r[c], np.int64)) for c in ("h", "vec_id", "members")]
                if embedding:
                    raw = pa.array(np.frombuffer(r["raw"], kind))
                    columns.append(pa.ListArray.from_arrays(pa.array(np.arange(0, len(raw) + 1, dims), pa.int32()), raw))
                yield pa.RecordBatch.from_arrays(columns, ["h", "vec_id", "members", "embedding"][: len(columns)])

    some = tiles.select("h", "vec_id", "members", *["raw"] * bool(embedding))
    return some.mapInArrow(unpack, "h long, vec_id long, members long" + f", embedding {embedding}" * bool(embedding))


def _moments(tiles: DataFrame, dims: int, kind: str) -> tuple[np.ndarray, int]:
    """Sum over all vectors of their outer products: one dims x dims matrix a partition, added in tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((dims, dims)), 0
        for batch in batches:
            for raw in batch["raw"]:
                vectors = np.frombuffer(raw.as_buffer(), kind).reshape(-1, dims)
                for at in range(0, len(vectors), ROWS_AT_ONCE):
                    x = unit_rows(vectors[at : at + ROWS_AT_ONCE].astype(np.float64))
                    total, n = total + x.T @ x, n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(dims), pa.int32()), "n": [n] * dims, "row": pa.array(list(total), pa.list_(pa.float64()))})

    rows = tiles.select("raw").mapInArrow(add, "at int, n long, row array<double>")
    sums = rows.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(F.col("row")[k]).alias(f"c{k}") for k in range(dims)]).collect()
    out, n = np.zeros((dims, dims)), 0
    for r in sums:
        out[r["at"]], n = [r[f"c{k}"] for k in range(dims)], r["n"]
    return (out + out.T) / 2, n


def _by_rows(f, *of: np.ndarray) -> np.ndarray:
    return np.concatenate([f(*(x[at : at + ROWS_AT_ONCE] for x in of)) for at in range(0, len(of[0]), ROWS_AT_ONCE)])


def _full(raw: np.ndarray) -> np.ndarray:
    return _by_rows(lambda x: unit_rows(x.astype(np.float64)).astype(np.float32), raw)


def _centres(full: np.ndarray, hood: np.ndarray) -> np.ndarray:
    centres = np.add.reduceat(full.astype(np.float64), np.flatnonzero(np.diff(hood, prepend=-1)), axis=0)
    length = np.sqrt((centres * centres).sum(1, keepdims=True))
    flat = length[:, 0] < 1e-6  # no direction: any will do
    centres[flat], length[flat] = np.eye(1, full.shape[1]), 1.0
    return (centres / length).astype(np.float32)


def _hoods(cell: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by neighbourhoods (parts of a cell) and by the angle to their centre; the neighbourhood and the angle
    of each in that order."""
    full = _full(raw)
    runs = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
    starts = np.concatenate([np.arange(a, b, NEIGHBOURS) for a, b in zip(runs, runs[1:], strict=False)])
    hood = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(cell))))
    centres = _centres(full, hood)
    angle = _by_rows(lambda x, h: np.arccos(np.clip(np.einsum("ij,ij->i", x, centres[h]), -1, 1)), full, hood)
    order = np.lexsort((angle, hood))
    return order, hood, angle[order]


class Tile:
    """Vectors prepared to be compared: in 32 bits, shortened, and in neighbourhoods with a centre.  A neighbourhood is
    cut by the angle to its centre into groups, each with the cosines to the centre between which a vector must be
    to link with one of the group."""

    def __init__(self, space: Subspaces, hood: np.ndarray, angle: np.ndarray, ids: np.ndarray, members: np.ndarray, raw: np.ndarray):
        self.ids, self.members, self.raw = ids, members.astype(np.float64), raw
        self.single = bool((members == 1).all())
        self.full = _full(raw)
        self.short = _by_rows(space.short, self.full)
        self.centres = _centres(self.full, hood)
        begins = np.flatnonzero(np.diff(hood, prepend=-1))
        self.starts = np.concatenate([np.arange(a, b, GROUP) for a, b in zip(begins, np.append(begins[1:], len(ids)), strict=True)])
        self.ends = np.append(self.starts[1:], len(ids))
        self.hood = hood[self.starts]
        angle = angle.astype(np.float64)
        far = np.maximum.reduceat(angle, self.starts) + space.reach + space.angle_blur
        near = np.minimum.reduceat(angle, self.starts) - space.reach - space.angle_blur
        self.least = (np.cos(np.minimum(far, math.pi)) - space.blur).astype(np.float32)
        self.most = np.where(near > 0, np.cos(np.maximum(near, 0)) + space.blur, 2.0).astype(np.float32)
        self.bytes = sum(x.nbytes for x in (self.ids, self.members, self.raw, self.short, self.full, self.centres))


def _linked(space: Subspaces, left: Tile, right: Tile, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs link: by their cosine in 32 bits, in double precision where that is too near the threshold."""
    out = np.empty(len(a), bool)
    at_once = max(1, NUMBERS_AT_ONCE // left.full.shape[1])
    for at in range(0, len(a), at_once):
        x, y = a[at : at + at_once], b[at : at + at_once]
        cosine = np.einsum("ij,ij->i", left.full[x], right.full[y])
        link = cosine >= space.sure
        edge = np.flatnonzero((cosine >= space.never) & ~link)
        if len(edge):
            one, two = (unit_rows(t.raw[of[edge]].astype(np.float64)) for t, of in ((left, x), (right, y)))
            link[edge] = (one * two).sum(1) >= space.min_cosine
        out[at : at + at_once] = link
    return out


def _meet(space: Subspaces, left: Tile, right: Tile | None) -> pa.Table:
    """Link counts of all pairs of two tiles, or of one, and a spanning forest of their links."""
    triangle = right is None
    right = left if triangle else right
    shift = 0 if triangle else len(left.ids)
    ids = left.ids if triangle else np.concatenate([left.ids, right.ids])
    count, root = np.zeros(len(ids)), np.arange(len(ids))
    open_, waiting, to_verify, unsure = [], 0, [], 0
    # what is scored at once, in the same memory each time
    most = max(SCORES_AT_ONCE, GROUP)
    scores, hit = np.empty(most, np.float32), np.zeros(-(-most // 8) * 8, bool)

    def connect(some: int) -> None:
        nonlocal open_, waiting
        if waiting > some:
            _connect(root, *(np.concatenate(x) for x in zip(*open_, strict=True)))
            open_, waiting = [], 0

    def verify_each(some: int) -> None:
        nonlocal waiting, to_verify, unsure
        if unsure <= some:
            return
        a, b = (np.concatenate(x) for x in zip(*to_verify, strict=True))
        to_verify, unsure = [], 0
        link = _linked(space, left, right, a, b)
        a, b = a[link], b[link]
        if len(a):
            np.add.at(count, a, right.members[b])
            np.add.at(count, b + shift, left.members[a])
            open_.append((a, b + shift))
            waiting += len(a)
            connect(PAIRS_AT_ONCE)

    def verify_all(rows: np.ndarray, begin: int, end: int) -> None:
        """Of a block most of which may link."""
        nonlocal waiting
        cosine = left.full[rows] @ right.full[begin:end].T
        link, edge = cosine >= space.sure, cosine >= space.never
        if triangle:
            ahead = rows[:, None] < np.arange(begin, end)
            link, edge = link & ahead, edge & ahead
        a, b = np.nonzero(edge & ~link)
        link[a, b] = _linked(space, left, right, rows[a], begin + b)
        both = left.single and right.single
        np.add.at(count, rows, np.count_nonzero(link, axis=1) if both else link @ right.members[begin:end])
        count[shift + begin : shift + end] += np.count_nonzero(link, axis=0) if both else left.members[rows] @ link
        a, b = np.nonzero(link & (root[rows][:, None] != root[shift + begin : shift + end]))
        if len(a):
            open_.append((rows[a], b + (begin + shift)))
            waiting += len(a)
            connect(PAIRS_AT_ONCE)

    for first in range(0, len(right.centres), HOODS_AT_ONCE):
        cosines = np.empty((len(right.centres[first : first + HOODS_AT_ONCE]), len(left.ids)), np.float32)
        for at in range(0, len(left.ids), ROWS_AT_ONCE):
            np.matmul(right.centres[first : first + HOODS_AT_ONCE], left.full[at : at + ROWS_AT_ONCE].T, out=cosines[:, at : at + ROWS_AT_ONCE])
        for group in range(*np.searchsorted(right.hood, [first, first + HOODS_AT_ONCE])):
            begin, end = right.starts[group], right.ends[group]
            cosine = cosines[right.hood[group] - first, : end if triangle else None]
            near = cosine >= right.least[group]
            if right.most[group] < 1:
                near &= cosine <= right.most[group]
            rows = np.flatnonzero(near)
            columns = np.ascontiguousarray(right.short[begin:end].T)
            wide = end - begin
            at_once = max(1, SCORES_AT_ONCE // wide)
            for at in range(0, len(rows), at_once):
                some = rows[at : at + at_once]
                size = len(some) * wide
                score, hits = scores[:size].reshape(-1, wide), hit[:size].reshape(-1, wide)
                np.matmul(np.take(left.short, some, axis=0), columns, out=score)
                np.greater_equal(score, space.least_score, out=hits)
                if triangle and some[-1] >= begin:  # each pair once
                    hits &= some[:, None] < np.arange(begin, end)
                hit[size : -(-size // 8) * 8] = False
                # few are hits: eight at a time are passed over
                eights = hit[: -(-size // 8) * 8].reshape(-1, 8)
                any_ = np.flatnonzero(eights.view(np.uint64)[:, 0] != 0)
                if len(any_) * 16 > size and np.count_nonzero(hits) * 8 > size:
                    verify_all(some, begin, end)
                    continue
                for part in range(0, len(any_), PAIRS_AT_ONCE // 8):
                    few = any_[part : part + PAIRS_AT_ONCE // 8]
                    at_few, bit = np.nonzero(eights[few])
                    a, b = np.divmod(few[at_few] * 8 + bit, wide)
                    to_verify.append((some[a], begin + b))
                    unsure += len(a)
                    verify_each(PAIRS_AT_ONCE // 16)
    verify_each(0)
    connect(0)
    own = np.flatnonzero(count)
    low = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(low, root[own], ids[own])
    return pa.table({"vec_id": ids[own], "root": low[root[own]], "n": count[own].astype(np.int64)})


def _compare(space, dims: int, min_cosine: float, kind: str = "<f4"):
    """Compares a table of vectors with itself, or with another one.  Tables prepared before can be given, too."""

    def prepared(group: pa.Table) -> Tile:
        raw = np.frombuffer(b"".join(group["raw"].to_pylist()), kind).reshape(-1, dims)
        order, hood, angle = _hoods(group["cell"].to_numpy(), raw)
        return Tile(space.value, hood, angle, group["vec_id"].to_numpy()[order], group["members"].to_numpy()[order], raw[order])

    def links(group: pa.Table | Tile, other: pa.Table | Tile | None = None) -> pa.Table:
        one, two = (prepared(x) if isinstance(x, pa.Table) else x for x in (group, other))
        assert space.value.min_cosine == min_cosine
        return _meet(space.value, one, two)

    return links


def _connect(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Folds pairs into ``root``, which holds for every member the smallest one it is connected to."""
    open_ = root[a] != root[b]
    while open_.any():
        a, b = a[open_], b[open_]
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            further = root[root]
            if (further == root).all():
                break
            root[:] = further
        open_ = root[a] != root[b]


LINKS = "vec_id long, root long, n long"


def _links(tiles: DataFrame, dims: int, n: int, kind: str, blocks: int, grid_dims: int, min_cosine: float) -> DataFrame:
    """Link counts and a spanning forest of the classes, all of one length.  Every tile meets itself and every
    other once, in a join that reads both from the shared folder; nothing is shuffled for it."""
    space = tiles.sparkSession.sparkContext.broadcast(Subspaces(*_moments(tiles, dims, kind), blocks, grid_dims, min_cosine))
    links = _compare(space, dims, min_cosine, kind)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Tile] = {}

        def tile(batch: pa.RecordBatch, k: int, side: str) -> Tile:
            name = batch[f"tile{side}"][k].as_py()
            if name not in kept:
                columns = (("hood", np.int64), ("angle", np.float32), ("vec_id", np.int64), ("members", np.int64), ("raw", kind))
                *numbers, raw = (np.frombuffer(batch[f"{c}{side}"][k].as_py(), of) for c, of in columns)
                made = Tile(space.value, *numbers, raw.reshape(-1, dims))
                while kept and made.bytes + sum(t.bytes for t in kept.values()) > KEPT_BYTES:
                    del kept[next(iter(kept))]
                kept[name] = made
            return kept[name]

        for batch in batches:
            for k in range(batch.num_rows):
                one = tile(batch, k, "")
                same = batch["tile"][k].as_py() == batch["tile_"][k].as_py()
                yield from links(one, None if same else tile(batch, k, "_")).to_batches()

    ranges = max(RANGES, n * dims * np.dtype(kind).itemsize // RANGE_BYTES)
    left = tiles.select("tile", "hood", "angle", "vec_id", "members", "raw").coalesce(ranges)
    right = left.select(*[F.col(c).alias(f"{c}_") for c in left.columns])
    # of both orders of a pair the one that leaves every task half of its pairs
    turn = F.pmod(F.xxhash64(F.least("tile", "tile_"), F.greatest("tile", "tile_")), F.lit(2)) == 0
    once = (F.col("tile") == F.col("tile_")) | ((F.col("tile") != F.col("tile_")) & ((F.col("tile") < F.col("tile_")) == turn))
    return staged(left.join(right.hint("shuffle_replicate_nl"), once).mapInArrow(meet, LINKS))


def near_duplicate_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, blocks: int = BLOCKS, grid_dims: int = GRID_DIMS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Equal vectors are one class, joined through its smallest vec_id and counted with its size.  Where two tiles
    meet links are only counted, and a spanning forest of them leaves the task, so a group of near copies puts
    out its size, not its pairs.  Vectors of different lengths never link; each length that two rows have
    is joined on its own, one after the other.  A vector that is null, empty, zero, or holds null or non-finite
    components links with nothing; so does a row with a null vec_id (component null, not kept).  Rows that
    repeat a vec_id count as different vectors of one node; an empty table gives no rows.  Cosines are taken in
    double precision of the components as they are stored (32 or 64 bits), of any size.  Rows find their class by
    a hash of the vector; if two classes have the same, by the vector itself."""
    bound_bytes(vectors.sparkSession)
    kind = "float" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite & some, F.lit(False))
    usable = rows.where(good).withColumn("h", _digest(F.col("embedding")))
    lengths = usable.groupBy(F.size("embedding").alias("d")).count().where("count > 1").orderBy("d").collect()
    found = vectors.sparkSession.createDataFrame([], LINKS)
    packed = []
    for dims, n in ((r["d"], r["count"]) for r in lengths):
        packed.append((_tiles(usable.where(F.size("embedding") == dims), dims, n), dims))
        found = found.unionByName(_links(packed[-1][0], dims, n, _stored_kind(rows), blocks, grid_dims, min_cosine))

    def classes(embedding: str | None = None) -> DataFrame:
        out = vectors.sparkSession.createDataFrame([], "h long, vec_id long, members long" + f", embedding {embedding}" * bool(embedding))
        for tiles, dims in packed:
            out = out.unionByName(_unpacked(tiles, dims, embedding))
        return out

    alike = classes().groupBy("h").count().where("count > 1").limit(1).count() > 0
    parts = connected_components(found, "vec_id", "root")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    named = classes(f"array<{kind}>" if alike else None).join(counts, "vec_id", "left").join(parts, F.col("vec_id") == F.col("node"), "left").select(
        F.col("h").alias("_h"),
        *[F.col("embedding").alias("_e")] * alike,
        (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    rows = rows.select("vec_id", F.when(good, _digest(F.col("embedding"))).alias("h"), *["embedding"] * alike)
    on = rows["h"] == named["_h"]
    out = rows.join(named, on & (rows["embedding"] == named["_e"]) if alike else on, "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
    out = out.withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
""".replace("WITH v", "WITH RECURSIVE v", 1)
