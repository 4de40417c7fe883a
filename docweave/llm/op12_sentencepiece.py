"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

A text's symbols are merged by an agenda of adjacent pairs: the pair whose piece has the best score is merged
first, of equal scores the leftmost, until no adjacent pair is a piece.  What the vocabulary lacks becomes byte
pieces.  The segments of a group of texts that have not been met are merged together, in arrays.  The sentencepiece library encodes and decodes every text, too, in the same Arrow batches, as a check."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_bytes, read

SPACE = "▁"
REPLACEMENT = "�"
#: Segments up to this length are remembered, so many of them for each worker, twice.
MEMO_CHARS = 32
MEMO_SIZE = 1 << 20
#: New segments of one length are merged together from so many on, at most so many at once, those of texts of about
#: so many characters.
MANY = 16
MERGED_AT_ONCE = 1 << 14
GROUP_CHARS = 1 << 18


class Pieces(dict):
    """A vocabulary, and the ids (packed) of the segments met so far."""

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = model.ModelProto.SentencePiece
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        if trainer.model_type != model.TrainerSpec.BPE or not trainer.byte_fallback or not plain or trainer.treat_whitespace_as_suffix:
            raise ValueError("a merge-type vocabulary with byte fallback and no text normalization is needed")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.dummy = SPACE if spec.add_dummy_prefix else ""
        self.begin, self.end = pack("<I", trainer.bos_id), pack("<I", trainer.eos_id)
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        #: what each id is decoded to, as bytes (control pieces to none: theirs mark them)
        self.surface: list[bytes] = []
        self.is_byte = [p.type == kinds.BYTE for p in proto.pieces]
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.NORMAL:
                self.ids[p.piece] = i
                self.surface.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            else:
                self.surface.append(trainer.unk_surface.encode() if p.type == kinds.UNKNOWN else b"\xff")
        self.surfaces = np.array(self.surface, object)
        scores = sorted({p.score for p in proto.pieces}, reverse=True)
        order = {score: k for k, score in enumerate(scores, 1)}
        if max(map(len, self.ids)) > 0xFF:
            raise ValueError("a piece is too long")
        #: a piece's agenda entry at the text's start: best scores first, then leftmost, and its width
        self.rank = {piece: order[proto.pieces[i].score] << 40 | len(piece) for piece, i in self.ids.items()}
        #: a piece's place by score alone
        self.place = {piece: own >> 40 for piece, own in self.rank.items()}
        self.last = len(scores) + 1
        self.known = {piece: pack("<I", i) for piece, i in self.ids.items()}
        #: pieces whose first space the decoder drops at a text's beginning
        self.spaced = {i for p, i in self.ids.items() if p.startswith(SPACE)} if self.dummy else set()
        self.control = {i for i, p in enumerate(proto.pieces) if p.type == kinds.CONTROL}
        self.segment = self._segments()
        self._pairs(order, [proto.pieces[i].score for i in range(len(proto.pieces))])

    def _pairs(self, order: dict[float, int], score: list[float]) -> None:
        """Tables for ``merge_many``.  A symbol's number is its id; characters of pieces that are no piece themselves
        come after the ids.  Each two symbols that make a piece have a key, a place and that piece."""
        joined = [p for p in self.ids if len(p) > 1]
        number = dict(self.ids)
        for c in sorted(set("".join(joined)) | {SPACE}):
            number.setdefault(c, len(score) + len(number) - len(self.ids))
        self.n_symbols = len(score) + len(number) - len(self.ids)
        self.n_ids = len(score)
        self.number_of = np.full(0x110000, -1, np.int32)
        for symbol, k in number.items():
            if len(symbol) == 1:
                self.number_of[ord(symbol)] = k
        pairs = {}
        for piece in joined:
            own = order[score[self.ids[piece]]], self.ids[piece]
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.n_symbols + b] = own
        keys = sorted(pairs)
        self.pair_key = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        self.pair_place = np.array([*(pairs[k][0] for k in keys), self.last], np.int32)
        self.pair_piece = np.array([*(pairs[k][1] for k in keys), -1], np.int32)

    def _segments(self) -> re.Pattern:
        """Cuts a text where no piece joins its two sides: around each character that no piece of two or more
        holds and, where the vocabulary has no piece with a space after another character, before spaces."""
        joined = [p for p in self.ids if len(p) > 1]
        letters = "".join(re.escape(c) for c in sorted(set("".join(joined)) - {SPACE}))
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in joined):
            return re.compile(f"[{SPACE}{letters}]+|.", re.DOTALL)
        return re.compile(f"{SPACE}+[{letters}]*|[{letters}]+|.", re.DOTALL)

    def merge_short(self, segment: str) -> bytes:
        """The same agenda as a list: each adjacent pair's place (``last`` where it is no piece), looked through for
        the best, leftmost one.  A segment of few symbols takes a fraction of the time that numbered entries do."""
        place, last = self.place.get, self.last
        symbols = list(segment)
        agenda = [place(a + b, last) for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := min(agenda)) != last:
            i = agenda.index(best)
            own = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = place(own + symbols[i + 1], last)
            if i:
                agenda[i - 1] = place(symbols[i - 1] + own, last)
        known = self.known
        return b"".join([known.get(x) or self.packed_symbol(x) for x in symbols])

    def _pair_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Each two symbols' row of the pair tables, the last where they make no piece."""
        key = a.astype(np.int64) * self.n_symbols + b
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, at, len(self.pair_key) - 1)

    def merge_many(self, segments: list[str]) -> list[bytes]:
        """``merge_short`` of segments of one length at once: a round merges the best, leftmost pair of every segment
        that still has one, so those left all have one symbol less."""
        out: list[bytes] = [b""] * len(segments)
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).reshape(len(segments), -1)
        symbols, rows = self.number_of[codes], np.arange(len(segments))
        odd = (symbols < 0).any(1)  # characters of no piece; `segment` leaves each of them alone
        for r in np.flatnonzero(odd).tolist():
            out[r] = self.merge_short(segments[r])
        symbols, rows = symbols[~odd], rows[~odd]
        pair = self._pair_of(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            n = symbols.shape[1]
            place = self.pair_place[pair]
            going = (place < self.last).any(1)
            ended = symbols[~going]
            packed = ended.astype("<u4").tobytes()
            plain = (ended < self.n_ids).all(1).tolist()
            for k, (r, whole) in enumerate(zip(rows[~going].tolist(), plain, strict=True)):
                out[r] = packed[4 * n * k : 4 * n * (k + 1)] if whole else self.merge_short(segments[r])
            symbols, pair, place, rows = symbols[going], pair[going], place[going], rows[going]
            if not len(rows):
                break
            line, at = np.arange(len(rows)), place.argmin(1)
            symbols[line, at] = self.pair_piece[pair[line, at]]
            symbols = symbols[np.arange(n) != at[:, None] + 1].reshape(len(rows), n - 1)
            pair = pair[np.arange(n - 1) != at[:, None]].reshape(len(rows), n - 2)
            for side in (at - 1, at):  # the pairs with the symbols before and after
                some = np.flatnonzero((side >= 0) & (side < n - 2))
                i = side[some]
                pair[some, i] = self._pair_of(symbols[some, i], symbols[some, i + 1])
        return out

    def learn(self, segments: set[str]) -> dict[str, bytes]:
        """The short new ones of ``segments``, those of one length merged together, which are remembered, too.  Where
        there are a few of a length, they are left to ``merge_short``."""
        fresh: dict[str, bytes] = {}
        by_length: dict[int, list[str]] = {}
        for segment in segments:
            if segment not in self.older:
                by_length.setdefault(len(segment), []).append(segment)
        for length, new in by_length.items():
            if 1 < length <= MEMO_CHARS and len(new) >= MANY:
                for at in range(0, len(new), MERGED_AT_ONCE):
                    part = new[at : at + MERGED_AT_ONCE]
                    fresh.update(zip(part, self.merge_many(part), strict=True))
        if len(self) + len(fresh) > MEMO_SIZE:
            self._age()
        if len(fresh) <= MEMO_SIZE:
            self.update(fresh)
        return fresh

    def _age(self) -> None:
        """What was met since the last time stays for another round."""
        self.older = dict(self)
        self.clear()

    def merge(self, segment: str) -> bytes:
        """The agenda over the adjacent pairs of a segment.  A symbol is the span from its start to ``end[start]``
        (0 once it has been merged into the one before); an entry is a number of rank, start and width."""
        n = len(segment)
        rank = self.rank.get
        agenda = [own + (i << 8) for i, own in enumerate(map(rank, map(str.__add__, segment, segment[1:]))) if own]
        if not agenda:
            return b"".join(map(self.packed_symbol, segment))
        end, before = list(range(1, n + 2)), list(range(-1, n))
        end[n] = -1
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry >> 8 & 0xFFFFFFFF
            j, k = end[i], i + (entry & 0xFF)
            if not j or end[j] != k:
                continue  # one of the two has been merged meanwhile
            end[i], end[j], before[k] = k, 0, i
            after, left = end[k], before[i]
            if after > 0 and (own := rank(segment[i:after])):
                heappush(agenda, own + (i << 8))
            if left >= 0 and (own := rank(segment[left:k])):
                heappush(agenda, own + (left << 8))
        i, out = 0, []
        while i < n:
            k = end[i]
            out.append(self.packed_symbol(segment[i:k]))
            i = k
        return b"".join(out)

    def packed_symbol(self, symbol: str) -> bytes:
        """A symbol's id, or those of its bytes where it is no piece."""
        return self.known.get(symbol) or b"".join([pack("<I", self.byte_ids[b]) for b in symbol.encode()])

    def __missing__(self, segment: str) -> bytes:
        got = self.older.get(segment)
        if got is None:
            got = self.merge_short(segment) if len(segment) <= MEMO_CHARS else self.merge(segment)
        if len(segment) <= MEMO_CHARS:
            if len(self) >= MEMO_SIZE:
                self._age()
            self[segment] = got
        return got

    def packed(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian 32-bit numbers."""
        return b"".join((self.begin, *map(self.__getitem__, self._cut(text)), self.end))

    def packed_all(self, texts: list[str]) -> Iterator[bytes]:
        """``packed`` of each text, in groups whose new segments are merged together."""
        at = 0
        while at < len(texts):
            group, chars = [], 0
            while at < len(texts) and chars < GROUP_CHARS:
                segments = self._cut(texts[at])
                met = [*map(self.get, segments)]
                group.append((met, [(i, s) for i, s in enumerate(segments) if met[i] is None] if None in met else []))
                chars += len(texts[at])
                at += 1
            fresh = self.learn({s for _, unmet in group for _, s in unmet})
            for met, unmet in group:
                for i, segment in unmet:
                    met[i] = fresh.get(segment) or self[segment]
                yield b"".join((self.begin, *met, self.end))

    def _cut(self, text: str) -> list[str]:
        return self.segment.findall(self.dummy + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; each byte that is part of no valid UTF-8 run of byte pieces gives U+FFFD."""
        first = next((k for k, i in enumerate(ids) if i not in self.control), len(ids))
        last = next((k for k in range(len(ids), first, -1) if ids[k - 1] not in self.control), first)
        core = ids[first:last]
        return self._decoded(np.array(core, np.int32))

    def decode_packed(self, packed: bytes) -> str:
        """``decode`` of what ``packed`` gives."""
        return self._decoded(np.frombuffer(packed, "<i4")[1:-1])

    def _decoded(self, core: np.ndarray) -> str:
        """The text of ids with no control piece at their ends."""
        if not len(core):
            return ""
        try:  # the whole is valid exactly if there is no control piece inside and every run of bytes is valid
            text = b"".join(self.surfaces[core].tolist()).decode()
        except UnicodeDecodeError:
            text = self._by_runs(core.tolist())
        return text[1:] if int(core[0]) in self.spaced else text

    def _by_runs(self, ids: list[int]) -> str:
        out, run = [], bytearray()

        def close() -> None:
            while run:
                try:
                    out.append(run.decode())
                    run.clear()
                except UnicodeDecodeError as e:
                    out.append(run[: e.start].decode() + REPLACEMENT)
                    del run[: e.start + 1]

        for i in ids:
            if self.is_byte[i]:
                run += self.surface[i]
            else:
                close()
                if i not in self.control:
                    out.append(self.surface[i].decode())
        close()
        return "".join(out)


@cache
def _pieces(path: str) -> Pieces:
    return Pieces(path)


@cache
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encoded(batches: Iterator[pa.RecordBatch], path: str, check: bool) -> Iterator[tuple[pa.Array, list[bytes], list[str], list]]:
    """(doc ids, packed ids, decoded texts, whether the library agrees) of each batch."""
    pieces, library = _pieces(path), _library(path) if check else None
    for batch in batches:
        ids, decoded, agrees = [], [], []
        texts = [text or "" for text in batch["text"].to_pylist()]
        for text, own in zip(texts, pieces.packed_all(texts), strict=True):
            back = pieces.decode_packed(own)
            ids.append(own)
            decoded.append(back)
            same = None
            if library is not None:
                theirs = library.encode(text, add_bos=True, add_eos=True)
                same = array("I", theirs).tobytes() == own and library.decode(theirs) == back
            agrees.append(same)
        yield batch["doc_id"], ids, decoded, agrees


def _documents(docs: DataFrame) -> DataFrame:
    bound_bytes(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode_documents(docs: DataFrame, model: str | None = None, check: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, decoded string, agrees boolean) for every row of (doc_id, text).

    ids have the begin and end id; ``agrees`` says that the library gives the same ids and the same decoded text
    (null without ``check``).  ``model`` is a file that every executor can open, with a merge-type vocabulary.  A
    null text counts as empty: begin and end alone.  Whole texts of any length are encoded; rows that repeat, or
    have a null doc_id, each on their own.  Only doc_id and text are read.  An empty table gives no rows.  Nothing
    is shuffled, and a batch is bounded by its bytes."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids, decoded, agrees in _encoded(batches, path, check):
            lists = pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32()))
            columns = [doc_id, lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded", "agrees"])

    return _documents(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string, agrees boolean")


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text, ids outside the vocabulary fail."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    bound_bytes(encoded.sparkSession)
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str | None = None, check: bool = True) -> DataFrame:
    """``encode_documents`` with the ids and the decoded text as digests: (doc_id, n_tokens, ids_sha256 of the ids
    as little-endian 32-bit numbers, decoded_sha256 of UTF-8, agrees)."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids, decoded, agrees in _encoded(batches, path, check):
            own = [hashlib.sha256(x).hexdigest() for x in ids]
            back = [hashlib.sha256(x.encode()).hexdigest() for x in decoded]
            columns = [doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string()), pa.array(agrees, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"])

    return _documents(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
