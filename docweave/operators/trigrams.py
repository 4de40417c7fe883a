"""Q1 by index: a trigram inverted index over a stored table's content, and regex search that reads only the
files and rows which can match.

A posting lists the rows of one data file that hold a trigram.  A table's files are never changed, so the index
grows by the files that were added since.  For a search, the trigrams that every match must hold are derived from
the pattern's parse; the postings of the rarest of them are intersected, the surviving rows' files are read, and
the pattern itself decides (``rlike``).  A pattern without such trigrams scans the table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import reliable_checkpoint
from ..sources import tables as TB
from . import batches as BT
from . import search as SR

GRAM = 3
#: Postings lie in folders by hash of the trigram.
BUCKETS = 64
#: Alternatives of a pattern that are told apart; of one alternative the rarest trigrams, so many.
MOST_ALTERNATIVES = 16
MOST_GRAMS = 8

#: Characters whose case-insensitive match is an ASCII letter, and that letter.
FOLD_FROM, FOLD_TO = "İıſK", "iisk"
POSTINGS = "gram string, file string, rows array<long>, n long, bucket int"


def folded(text: Column) -> Column:
    """Text as the index compares it: what matches a letter regardless of case is that lower-case letter.  Only
    ASCII letters are folded; trigrams with other characters are not indexed."""
    upper = "".join(chr(c) for c in range(65, 91))
    return F.translate(text, upper + FOLD_FROM, upper.lower() + FOLD_TO)


def trigrams(text: Column) -> Column:
    """The distinct trigrams of printable ASCII characters of a folded text."""
    return F.array_distinct(F.regexp_extract_all(folded(text), F.lit(r"(?=([\x20-\x7e]{3}))"), F.lit(1)))


#: (trigram, row) pairs that a task holds before it hands their postings on.
PAIRS_AT_ONCE = 1 << 21


def _pairs(texts: pa.Array, first: int) -> np.ndarray:
    """Each distinct (trigram, place of its text from ``first``) of folded texts as trigram << 32 | place.  A
    trigram is three bytes of printable ASCII in a row; a byte of any other character is none."""
    texts = pa.concat_arrays([texts.fill_null("")]).cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    found = []
    for a in range(0, max(0, len(data) - GRAM + 1), BT.PART_BYTES):  # a long text in windows
        cut = data[a : a + BT.PART_BYTES + GRAM - 1]
        own = (np.searchsorted(ends, np.arange(a, a + len(cut)) + ends[0], "right") - 1 + first).astype(np.uint64)
        plain = (cut >= 0x20) & (cut <= 0x7E)
        at = np.flatnonzero(plain[:-2] & plain[1:-1] & plain[2:] & (own[:-2] == own[2:]))
        letters = [cut[at + k].astype(np.uint64) << np.uint64(48 - 8 * k) for k in range(GRAM)]
        found.append(np.unique(letters[0] | letters[1] | letters[2] | own[at]))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def _postings_of(pairs: np.ndarray, rows: np.ndarray, file: str) -> pa.RecordBatch:
    """One posting for each trigram of the sorted pairs."""
    gram, place = pairs >> np.uint64(32), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.diff(gram, prepend=np.uint64(0)))  # no trigram is 0
    letters = np.stack([(gram[starts] >> np.uint64(s)).astype(np.uint8) for s in (16, 8, 0)], axis=1)
    grams = pa.FixedSizeBinaryArray.from_buffers(pa.binary(GRAM), len(starts), [None, pa.py_buffer(letters.tobytes())])
    lists = pa.ListArray.from_arrays(pa.array([*starts, len(pairs)], pa.int32()), pa.array(rows[place], pa.int64()))
    columns = [grams.cast(pa.binary()).cast(pa.string()), pa.array([file] * len(starts), pa.string()), lists]
    return pa.RecordBatch.from_arrays(columns, ["gram", "file", "rows"])


def _invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, file, rows) from rows of (file, row, folded text).  Rows of a file come one after another; a trigram
    has a posting for each run of rows that is held at once."""
    file, held, rows, n, size = None, [], [], 0, 0

    def out() -> Iterator[pa.RecordBatch]:
        pairs = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
        if len(pairs):
            yield _postings_of(pairs, np.concatenate(rows), file)

    for part in BT.parts(batches):
        names = part.column(0).to_pylist()
        cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            if names[a] != file or size >= PAIRS_AT_ONCE:
                yield from out()
                file, held, rows, n, size = names[a], [], [], 0, 0
            own = part.slice(a, b - a)
            held.append(_pairs(own.column(2), n))
            rows.append(own.column(1).to_numpy(zero_copy_only=False))
            n, size = n + own.num_rows, size + len(held[-1])
    yield from out()


def _grams_of(run: str) -> frozenset[str]:
    own = "".join("iisk"[FOLD_FROM.index(c)] if c in FOLD_FROM else c.lower() if c.isascii() else c for c in run)
    cuts = (own[k : k + GRAM] for k in range(len(own) - GRAM + 1))
    return frozenset(g for g in cuts if all(" " <= c <= "~" for c in g))


def required_trigrams(query: str) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams: a text that matches the (case-insensitive) pattern holds all of at
    least one.  An empty set among them says that nothing is required.  A pattern that Python cannot parse, or
    whose parse depends on flags of its own, requires nothing."""
    from re import _constants as C
    from re import _parser

    try:
        tree = _parser.parse(query)
    except (re.error, RecursionError, OverflowError):
        return [frozenset()]
    if tree.state.flags & (re.VERBOSE | re.ASCII | re.LOCALE):
        return [frozenset()]

    def both(a: list[frozenset], b: list[frozenset]) -> list[frozenset]:
        if len(a) * len(b) > MOST_ALTERNATIVES:  # the side that requires more stays
            return max(a, b, key=lambda x: min(map(len, x)))
        return list({x | y for x in a for y in b})

    def of(items) -> list[frozenset]:
        found, run = [frozenset()], ""
        for op, value in [*items, (None, None)]:
            if op is C.LITERAL:
                run += chr(value)
                continue
            if run:
                found, run = both(found, [_grams_of(run)]), ""
            if op is C.SUBPATTERN:
                found = both(found, of(value[3]))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] > 0:
                found = both(found, of(value[2]))
            elif op is C.ATOMIC_GROUP:
                found = both(found, of(value))
            elif op is C.BRANCH:
                branches = [x for branch in value[1] for x in of(branch)]
                if len(set(branches)) <= MOST_ALTERNATIVES:
                    found = both(found, list(set(branches)))
        return found

    alternatives = set(of(tree))
    return [frozenset()] if frozenset() in alternatives else sorted(alternatives, key=sorted)


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_trigrams/{name}"


def _postings(spark: SparkSession, root: str, name: str) -> DataFrame:
    fs, path = TB._fs(spark, _folder(root, name))
    return spark.read.schema(POSTINGS).parquet(_folder(root, name)) if fs.exists(path) else spark.createDataFrame([], POSTINGS)


def _files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table's data files: the names Spark's scan has for them."""
    return TB.files_of(spark, root, name).select("file")


def unindexed(spark: SparkSession, root: str, name: str) -> list[str]:
    """Files without postings.  A file's own entry has an empty trigram, so one without any trigram is known, too."""
    known = _postings(spark, root, name).where((F.col("bucket") == _bucket_of("")) & (F.col("gram") == "")).select("file")
    return sorted(r[0] for r in _files(spark, root, name).join(known, "file", "left_anti").collect())


def _bucket(gram: Column) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(BUCKETS)).cast("int")


def _bucket_of(gram: str) -> int:
    import zlib

    return zlib.crc32(gram.encode()) % BUCKETS


def _read(spark: SparkSession, root: str, name: str, files: Sequence[str]) -> DataFrame:
    """Rows of some of a table's files, with ``_file`` and ``_row``."""
    reader = spark.read.schema(TB.stored_schema(name)).option("basePath", TB._path(root, name))
    return reader.parquet(*files).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def update_index(spark: SparkSession, root: str, name: str) -> int:
    """Adds the postings of the files that have none yet; returns how many files those were.  A task inverts the
    rows that it reads, so postings are moved, not (trigram, row) pairs.  A run that fails leaves nothing behind: its postings become visible in one folder rename."""
    files = unindexed(spark, root, name)
    if not files:
        return 0
    texts = _read(spark, root, name, files).select("_file", "_row", folded(F.col("content")).alias("_text"))
    held = BT.map_batches(texts, _invert, "gram string, file string, rows array<long>")
    entries = spark.createDataFrame([(f,) for f in files], "file string").select(
        F.lit("").alias("gram"), "file", F.array().cast("array<long>").alias("rows")
    )
    every = held.unionByName(entries).withColumn("n", F.size("rows").cast("long")).withColumn("bucket", _bucket(F.col("gram")))
    staged, done = f"{root.rstrip('/')}/_trigrams/_staged-{uuid.uuid4().hex}", f"{_folder(root, name)}/run={uuid.uuid4().hex}"
    dealt = every.repartition("bucket").sortWithinPartitions("bucket", "gram")
    dealt.write.partitionBy("bucket").parquet(staged)
    fs, target = TB._fs(spark, done)
    fs.mkdirs(target.getParent())
    if not fs.rename(TB._fs(spark, staged)[1], target):
        raise OSError(f"{done} could not be written")
    return len(files)


def _survivors(spark: SparkSession, root: str, name: str, alternatives: list[frozenset[str]]) -> DataFrame:
    """(file, row) of the indexed rows that hold all chosen trigrams of an alternative."""
    needed = sorted(frozenset().union(*alternatives))
    buckets = sorted({_bucket_of(g) for g in needed})
    postings = _postings(spark, root, name).where(F.col("bucket").isin(buckets) & F.col("gram").isin(needed))
    held = {r["gram"]: r["n"] for r in postings.groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # of the pattern's trigrams
    chosen = [sorted(a, key=lambda g: (held.get(g, 0), g))[:MOST_GRAMS] for a in alternatives if all(g in held for g in a)]
    if not chosen:
        return spark.createDataFrame([], "file string, row long")
    used = sorted(set().union(*chosen))
    rows = postings.where(F.col("gram").isin(used)).select("file", F.explode("rows").alias("row"), "gram")
    has = {g: F.bool_or(F.col("gram") == g).alias(f"g{k}") for k, g in enumerate(used)}
    marked = rows.groupBy("file", "row").agg(*has.values())
    fits = F.lit(False)
    for own in chosen:
        whole = F.lit(True)
        for g in own:
            whole = whole & F.col(f"g{used.index(g)}")
        fits = fits | whole
    return marked.where(fits).select("file", "row")


def candidate_rows(spark: SparkSession, root: str, name: str, query: str) -> tuple[DataFrame, list[str]]:
    """The table's rows that may match, and the files they are read from: rows that survive the index, all rows of
    files that are not indexed yet, or the whole table if the pattern requires no trigram."""
    alternatives = required_trigrams(query)
    late = unindexed(spark, root, name)
    if frozenset() in alternatives:
        files = sorted(r[0] for r in _files(spark, root, name).collect())
        return (_read(spark, root, name, files).drop("_file", "_row") if files else TB.read_table(spark, root, name)), files
    found = reliable_checkpoint(_survivors(spark, root, name, alternatives))
    files = sorted(r[0] for r in found.select("file").distinct().collect())
    rows = TB.read_table(spark, root, name).limit(0)
    if files:
        own = _read(spark, root, name, files)
        on = (own["_file"] == found["file"]) & (own["_row"] == found["row"])
        rows = own.join(found, on, "left_semi").drop("_file", "_row")
    if late:
        rows = rows.unionByName(_read(spark, root, name, late).drop("_file", "_row"))
    return rows, sorted({*files, *late})


def search_indexed(spark: SparkSession, root: str, query: str, limit: int = S.DEFAULT_LIMIT, names: Sequence[str] = S.DOCUMENT_TABLES) -> DataFrame:
    """Q1 over stored tables: the same rows as ``search_documents`` over all of them."""
    SR.check_java_regex(spark, SR.search_pattern(query))
    tables: Mapping[str, DataFrame] = {name: candidate_rows(spark, root, name, query)[0] for name in names}
    return SR.search_documents(tables, query, limit)
