"""Fill-in-the-middle transformation: every text is cut at two lines that its id draws, through an indexable
skip list over its lines.

The lowest lane has a link for each line; every express lane above keeps about a quarter of the nodes below.
Each link carries its width in lines, in code points and in UTF-8 bytes, so a descent that adds up the widths it
passes reaches the node of a rank with the exact code point and byte position, in logarithmic steps."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_bytes, mix, read

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

SEED = 7
RATE = 100
SPM_RATE = 50

FIM = "n long, form string, prefix_chars long, middle_chars long, output string"


class SkipList:
    """The lines of a text's UTF-8 bytes (``[^\\n]*\\n|[^\\n]+``) under express lanes."""

    def __init__(self, raw: bytes):
        b = np.frombuffer(raw, np.uint8)
        ends = np.flatnonzero(b == 0x0A) + 1
        starts = np.concatenate([np.zeros(1, np.int64), ends])
        starts = starts[starts < len(b)]
        self.n = len(starts)
        #: lanes from the lowest: (line, code point and byte widths of the links, each node's place in the lane below)
        self.lanes: list[tuple[list[int], list[int], list[int], list[int]]] = []
        if not self.n:
            return
        chars = np.add.reduceat((b & 0xC0) != 0x80, starts, dtype=np.int64)
        lane = (np.ones(self.n, np.int64), chars, np.diff(starts, append=len(b)))
        nodes, place = np.arange(self.n), np.arange(self.n)
        towers = mix(nodes.astype(np.uint64))
        while True:
            self.lanes.append((*(w.tolist() for w in lane), place.tolist()))
            if len(nodes) <= 4:
                return
            towers = towers >> np.uint64(2)
            keep = (towers[nodes] & np.uint64(3)) == 0
            keep[0] = True  # the head stands in every lane
            place = np.flatnonzero(keep)
            lane = tuple(np.add.reduceat(w, place) for w in lane)
            nodes = nodes[place]

    def position(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) before the line of a rank; ``n`` is the text's end."""
        at = lines = chars = size = 0
        for own_lines, own_chars, own_bytes, below in reversed(self.lanes):
            while at < len(own_lines) and lines + own_lines[at] <= rank:
                lines += own_lines[at]
                chars += own_chars[at]
                size += own_bytes[at]
                at += 1
            if lines == rank:
                break
            at = below[at]
        return chars, size


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of ``seed:doc_id`` (nothing for a null id)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def transformed(doc_id: int | None, raw: bytes, seed: int, rate: int, spm_rate: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    lines = SkipList(raw)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or any(m.encode() in raw for m in MARKERS) or h3 % 100 >= rate:
        return lines.n, "plain", None, None, raw
    first, last = sorted((h1 % (lines.n + 1), h2 % (lines.n + 1)))
    (c1, b1), (c2, b2) = lines.position(first), lines.position(last)
    prefix, middle, suffix = raw[:b1], raw[b1:b2], raw[b2:]
    p, s, m = (x.encode() for x in MARKERS)
    if h4 % 100 < spm_rate:
        return lines.n, "spm", c1, c2 - c1, b"".join((s, suffix, p, prefix, m, middle))
    return lines.n, "psm", c1, c2 - c1, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with a struct ``fim``: n (lines), form (``plain``, ``psm`` or ``spm``), prefix_chars and
    middle_chars (code points; null if plain) and output.

    A text is cut before two lines drawn by its doc_id and ``seed``, the same in every run; ``rate`` per cent are
    transformed, ``spm_rate`` per cent of those with the suffix first.  Whole texts of any length are cut, a line
    never.  A null text counts as empty; an empty text, and one that holds a marker, stays plain.  A null doc_id
    draws as an empty id; rows that repeat are transformed alike, each on its own.  Other columns stay, but one
    named ``fim`` (in any case) is replaced.  An empty table gives no rows.  Nothing is shuffled: the texts pass a
    task in Arrow batches bounded by their bytes."""
    bound_bytes(docs.sparkSession)

    @F.arrow_udf(FIM)
    def transform(doc_id: pa.Array, text: pa.Array) -> pa.Array:
        texts = [x or b"" for x in text.cast(pa.binary()).to_pylist()]
        rows = [transformed(i, raw, seed, rate, spm_rate) for i, raw in zip(doc_id.to_pylist(), texts, strict=True)]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
        arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
        return pa.StructArray.from_arrays([*arrays, pa.array(output, pa.binary()).cast(pa.string())], [x.split()[0] for x in FIM.split(", ")])

    return docs.select(*[c for c in docs.columns if c.lower() != "fim"], transform(F.col("doc_id"), F.col("text")).alias("fim"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: a transformed text held no marker, so the three markers split it."""
    part = F.split(output, "|".join(MARKERS), -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    output, form = F.col("fim.output"), F.col("fim.form")
    return docs.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(output, form), 256).alias("restored_sha256"),
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS s, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (
  SELECT doc_id, s, regexp_extract_all(s, '[^\n]*\n|[^\n]+') AS lines,
    [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS d FROM t),
c AS (
  SELECT doc_id, s, lines, len(lines) AS n, d,
    least(d[1] % (len(lines) + 1), d[2] % (len(lines) + 1)) AS a,
    greatest(d[1] % (len(lines) + 1), d[2] % (len(lines) + 1)) AS b,
    s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR d[3] % 100 >= 100 AS plain FROM l),
p AS (
  SELECT doc_id, n, s,
    CASE WHEN plain THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(lines[1:a], '') AS pre, array_to_string(lines[a + 1:b], '') AS mid,
    array_to_string(lines[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN s ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
