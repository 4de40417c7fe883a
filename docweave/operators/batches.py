"""Arrow batches in parts: a Python stage whose memory follows neither the rows of a batch nor what they give."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import bound_batches, bound_bytes

#: A part has at most so many rows and, unless one row alone is larger, bytes.
PART_ROWS = 256
PART_BYTES = 1 << 20
#: Rows that leave a flat-map at once.
OUT_ROWS = 8192


def _halves(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if part.num_rows < 2 or part.nbytes <= PART_BYTES:
        yield part
    else:
        half = part.num_rows // 2
        yield from _halves(part.slice(0, half))
        yield from _halves(part.slice(half))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in their order, part by part."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield from _halves(batch.slice(at, PART_ROWS))


def regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in their order, so many at once (the last time: what is left)."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, rows - n)
            held.append(piece)
            at, n = at + piece.num_rows, n + piece.num_rows
            if n == rows:
                yield held[0] if len(held) == 1 else pa.concat_batches(held)
                held, n = [], 0
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` over batches that are bounded where the session does not say how."""
    bound_batches(df.sparkSession)
    bound_bytes(df.sparkSession)
    return df.mapInArrow(run, schema)


def flat_map_text(df: DataFrame, text_col: str, keys: list[str], fields: list[T.StructField], rows_of) -> DataFrame:
    """One output row for each tuple that ``rows_of(text)`` gives, after the row's keys."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([df.schema[k] for k in keys] + fields)
    own = to_arrow_schema(T.StructType(fields), prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            at: list[int] = []
            out: list[tuple] = []

            def full() -> pa.RecordBatch:
                index = pa.array(at, pa.int32())
                columns = [part.column(k).take(index) for k in range(len(keys))]
                columns += [pa.array([row[k] for row in out], f.type) for k, f in enumerate(own)]
                return pa.RecordBatch.from_arrays(columns, [*keys, *own.names])

            for row, text in enumerate(part.column(len(keys)).to_pylist()):
                for made in rows_of(text):
                    at.append(row)
                    out.append(made)
                    if len(out) == OUT_ROWS:
                        yield full()
                        at, out = [], []
            if out:
                yield full()

    return map_batches(df.select(*keys, text_col), run, schema)
