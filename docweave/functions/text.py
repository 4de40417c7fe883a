"""Column -> Column text functions.

Every function here is a composition of built-in Spark expressions, so it runs inside whole-stage
codegen with no Python round trip.  Where Python and Java disagree on a character class, the class
is spelled out so that the result equals the Python semantics the operator is defined by:

* Python ``\\s`` / ``str.strip()`` (Unicode whitespace) is Java ``(?U)\\s`` plus ``\\x1c-\\x1f``.
* Python ``str.title()`` works on runs of *cased* letters; Spark ``initcap`` only on blanks.
* Python ``re`` ``\\b`` is Unicode-aware, so word tokens are split on ``[^\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

# Python's Unicode whitespace, as a Java character class body.
WS = r"\s\x1c-\x1f"
WS_CLASS = rf"(?U)[{WS}]"
# Runs of cased letters (Unicode "Cased" = Lowercase + Uppercase + Titlecase).
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
# Characters that are neither printable nor whitespace for Python: "Other" categories minus the
# control characters Python counts as whitespace.
NON_PRINTABLE = r"[\p{C}&&[^\t\n\x0b\x0c\r\x1c-\x1f\x85]]"
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_lstrip(c) -> Column:
    return F.regexp_replace(_col(c), rf"^{WS_CLASS}+", "")


def py_rstrip(c) -> Column:
    return F.regexp_replace(_col(c), rf"{WS_CLASS}+\z", "")


def py_strip(c) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark ``trim`` strips spaces only)."""
    return py_rstrip(py_lstrip(c))


def clean_text(c) -> Column:
    """null/empty -> ''; whitespace runs -> one space; strip; then drop control characters.
    Control removal happens after the strip, so an edge space next to a control char survives."""
    collapsed = F.regexp_replace(_col(c), rf"{WS_CLASS}+", " ")
    stripped = F.trim(collapsed)  # only spaces are left as whitespace
    return F.coalesce(F.regexp_replace(stripped, CONTROL_CHARS, ""), F.lit(""))


def title_case(c) -> Column:
    """Python ``str.title()``: the first cased letter of every run of cased letters is upper-cased,
    the rest lower-cased."""
    runs = F.regexp_extract_all(_col(c), F.lit(f"([{CASED}]+|[^{CASED}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def title_from_filename(c) -> Column:
    """drop the text after the last dot, ``_``/``-`` -> space, title case."""
    stem = F.regexp_replace(_col(c), r"\.[^.]*$", "")
    spaced = F.translate(stem, "_-", "  ")
    return title_case(spaced)


def title_from_content(c, max_length: int = S.TITLE_MAX_LENGTH) -> Column:
    """first of the first five lines whose stripped length is in (5, max_length] and that carries
    no metadata marker; else the first ``max_length`` stripped characters cut after the first '.',
    or else at the first newline; blank -> null."""
    text = _col(c)
    lines = F.slice(F.split(text, "\n", 6), 1, 5)
    stripped = F.transform(lines, lambda ln: py_strip(ln))

    def usable(ln: Column) -> Column:
        low = F.lower(ln)
        marker = None
        for p in S.TITLE_SKIP_PATTERNS:
            hit = F.instr(low, p) > 0
            marker = hit if marker is None else (marker | hit)
        return (F.length(ln) > 5) & (F.length(ln) <= max_length) & ~marker

    from_lines = F.get(F.filter(stripped, usable), 0)
    head = F.left(py_lstrip(text), F.lit(max_length))
    cut = (
        F.when(F.instr(head, ".") > 0, F.concat(F.substring_index(head, ".", 1), F.lit(".")))
        .when(F.instr(head, "\n") > 0, F.substring_index(head, "\n", 1))
        .otherwise(head)
    )
    fallback = F.nullif(py_strip(cut), F.lit(""))
    blank = text.isNull() | (py_lstrip(text) == "")
    return F.when(blank, F.lit(None).cast("string")).otherwise(F.coalesce(from_lines, fallback))


def truncate_text(c, max_length: int = S.TRUNCATE_LENGTH) -> Column:
    """unchanged up to ``max_length``; else the first ``max_length`` characters, cut at the last
    space only if that space lies past 80 % of the length, then '...'."""
    text = _col(c)
    head = F.left(text, F.lit(max_length))
    rpos = F.instr(F.reverse(head), " ")  # 1-based position from the end, 0 = none
    last_space = F.when(rpos > 0, F.lit(max_length) - rpos).otherwise(F.lit(-1))
    cut = F.when(last_space > F.lit(max_length * 0.8), F.left(head, last_space)).otherwise(head)
    return F.when(F.length(text) <= max_length, text).otherwise(F.concat(cut, F.lit("...")))


def source_link(c) -> Column:
    """first of the first ten lines that (stripped, lower-cased) has a link prefix and an
    http(s) URL; the URL comes back lower-cased."""
    lines = F.slice(F.split(_col(c), "\n", 11), 1, 10)
    lowered = F.transform(lines, lambda ln: F.lower(py_strip(ln)))
    url = rf"https?://(?U)[^{WS}]+"

    def candidate(ln: Column) -> Column:
        prefix = None
        for p in S.SOURCE_LINK_PREFIXES:
            hit = F.instr(ln, p) > 0
            prefix = hit if prefix is None else (prefix | hit)
        return prefix & ln.rlike(url)

    first = F.get(F.filter(lowered, candidate), 0)
    return F.nullif(F.regexp_extract(first, url, 0), F.lit(""))


def content_md5(c) -> Column:
    """MD5 hex of the raw bytes."""
    return F.md5(_col(c))


def content_sha256(c) -> Column:
    """F8: SHA-256 hex of the raw bytes."""
    return F.sha2(_col(c), 256)


def document_id(prefix: str, sha256_hex, epoch_seconds) -> Column:
    """deterministic id ``{type}_{sha256[:16]}_{int(epoch)}`` (replaces random ids, so a task
    retry or a re-run produces the same id)."""
    return F.concat(
        F.lit(f"{prefix}_"), F.left(_col(sha256_hex), F.lit(16)), F.lit("_"), _col(epoch_seconds).cast("long").cast("string")
    )


def basename(c) -> Column:
    """last ``/`` segment of a path."""
    return F.substring_index(_col(c), "/", -1)


def split_bucket_key(c) -> tuple[Column, Column]:
    """First path segment (bucket) and the rest (key)."""
    p = _col(c)
    return F.substring_index(p, "/", 1), F.regexp_extract(p, r"^[^/]*/?(.*)$", 1)


def local_time(ts, zone: str = S.LOCAL_TIME_ZONE) -> Column:
    """a UTC wall-clock timestamp in the local zone, formatted ``yyyy-MM-dd HH:mm:ss``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts).cast("timestamp_ntz"))
    return F.substring(local.cast("string"), 1, 19)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 of a UTC wall-clock timestamp.  Every step works on the zone-free type, so the
    session's time zone has no say (a cast to TIMESTAMP would read the clock in that zone)."""
    t = _col(ts).cast("timestamp_ntz")
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def local_iso(ts, zone: str = S.LOCAL_TIME_ZONE) -> Column:
    """Zone-aware ISO text used in point payloads, e.g. ``2024-01-01T07:00:00+07:00``."""
    utc = _col(ts).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    offset = (epoch_seconds(local) - epoch_seconds(utc)).cast("int")
    sign = F.when(offset < 0, F.lit("-")).otherwise(F.lit("+"))
    hh = F.lpad((F.abs(offset) / 3600).cast("int").cast("string"), 2, "0")
    mm = F.lpad(((F.abs(offset) % 3600) / 60).cast("int").cast("string"), 2, "0")
    return F.concat(F.replace(F.substring(local.cast("string"), 1, 19), F.lit(" "), F.lit("T")), sign, hh, F.lit(":"), mm)


def validate_text_content(c) -> Column:
    """P5: struct(ok, reason): empty, shorter than 10 stripped characters, or less than 80 %
    printable-or-whitespace characters."""
    text = _col(c)
    stripped_len = F.length(py_strip(text))
    total = F.length(text)
    nonprint = total - F.length(F.regexp_replace(text, NON_PRINTABLE, ""))
    reason = (
        F.when(text.isNull() | (stripped_len == 0), F.lit(S.MSG_TEXT_EMPTY))
        .when(stripped_len < 10, F.lit(S.MSG_TEXT_SHORT))
        .when((total - nonprint) / total < 0.8, F.lit(S.MSG_TEXT_NONPRINTABLE))
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


