"""byte decoding cascade utf-8 -> utf-16 -> latin-1, as JVM expressions.

Spark's ``decode`` raises on malformed input, so each step is taken only after a check: valid UTF-8; an
even number of bytes without an unpaired surrogate (with a byte order mark the marked order, else
little-endian, which is Python's native order); any bytes at all.  Latin-1 never fails, so the codecs
that would follow it are unreachable and not built."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unpaired_surrogate(data: Column, little_endian: bool) -> Column:
    """Whether UTF-16 bytes hold a surrogate without its partner.  Every two bytes of the hex text become a
    dot, after the surrogate's lead byte where it is one; then proper pairs go, and no lead may be left."""
    unit = "..(D[89A-F])|...." if little_endian else "(D[89A-F])..|...."
    marked = F.regexp_replace(F.hex(data), unit, "$1.")
    return F.contains(F.regexp_replace(marked, r"D[89AB]\.D[C-F]\.", ""), F.lit("D"))


def _utf16(data: Column) -> Column:
    """Text of UTF-16 bytes, null where they are not."""
    mark = F.hex(F.substring(data, 1, 2))
    rest = F.substring(data, 3, 2147483647)
    big, little = mark == "FEFF", mark == "FFFE"
    body = F.when(big | little, rest).otherwise(data)
    even = F.octet_length(data) % 2 == 0
    return F.when(even & big & ~_unpaired_surrogate(body, False), F.decode(body, "UTF-16BE")).when(
        even & ~big & ~_unpaired_surrogate(body, True), F.decode(body, "UTF-16LE")
    )


def decode_bytes(content) -> Column:
    """struct(text, encoding) for a binary column; null in, null out."""
    c = F.col(content) if isinstance(content, str) else content
    wide = _utf16(c)

    def result(text: Column, name: str) -> Column:
        return F.struct(text.alias("text"), F.lit(name).alias("encoding"))

    return F.when(c.isNotNull() & F.is_valid_utf8(c.cast("string")), result(c.cast("string"), "utf-8")).when(
        c.isNotNull(), F.when(wide.isNotNull(), result(wide, "utf-16")).otherwise(result(F.decode(c, "ISO-8859-1"), "latin-1"))
    )
