"""Records of delimited files that are read in pieces.

A quoted field may hold line breaks, so where a piece of a file begins is not
where a record begins, and one task a file was the plain way out. Here every
file is split, whatever it holds:

1. *Lines.* One scan keeps every line as bytes, with its file, its piece
   (``block``) and its place, whether it is UTF-8 and whether it has a quote.
   This is the only time the files are read.
2. *Files.* One row per file: UTF-8 only if all its lines are, the delimiter
   from its first line, and whether any line has a quote.
3. *Files without quotes* are split and decoded per line, natively.
4. *Files with quotes.* A line begins either outside or inside a quoted
   field, and a piece maps the one it begins in to the one it ends in. The
   maps of a file's pieces, taken in order (a prefix sum of two-valued
   functions), tell where each piece begins; then each piece is split by
   itself. The record that a piece leaves open goes, as bytes, to a join of
   the pieces that hold it.
5. *Layouts.* The records are written once, in the order of the scan, with
   their header's digest; a frame per distinct header reads its own row
   groups. The distinct headers are all that the driver learns.

A record is a task's to hold, and so is a piece: what one scan task reads of a
file (``spark.sql.files.maxPartitionBytes``), cut again at every
``2**PIECE_BITS`` lines; a file is not. The pieces go to as many tasks as their
bytes ask for. Nothing is grouped by file but a row a piece. The table of files
is written, so joins with it know its size. A compressed file is read by one
task, as its bytes can only be read in order, and cut into pieces like others.

Quoting is as CSV readers elsewhere take it: a quote opens a field only at its
start, two within it stand for one, and text after the closing quote belongs
to the field. Line breaks are LF or CR LF; an empty line is no record; an
empty field is NULL.
"""

from __future__ import annotations

import csv
import math
import re
import uuid
from collections.abc import Iterable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import scratch_path

SEPARATORS = (";", ",", "\t")
_CHUNK = 50_000
PIECE_BITS = 16  # lines of a piece, as a power of two
TASK_BYTES = 8 << 20  # bytes of lines that one task splits
_PIECE = ["file", "block", "chunk"]
csv.field_size_limit(2**31 - 1)


@lru_cache
def _patterns(sep: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """From outside: a line that ends in an open field. From inside: the close. A field of a whole record."""
    s = re.escape(sep)
    quoted = r'"(?:[^"]|"")*+'
    opens = re.compile(rf'(?:(?:{quoted}"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+{quoted}\Z')
    closes = re.compile(rf'(?:[^"]|"")*+"[^{s}]*+(?:({s})|\Z)')
    field = re.compile(rf'(?:"((?:[^"]|"")*+)"?([^{s}]*+)|([^{s}]*+))({s}|\Z)')
    return opens, closes, field


def ends_inside(line: str, sep: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that begins inside one, or not."""
    opens, closes, _ = _patterns(sep)
    at = 0
    if inside:
        m = closes.match(line)
        if m is None:
            return True
        if m.group(1) is None:
            return False
        at = m.end()
    return opens.match(line, at) is not None


def split_record(text: str, sep: str) -> list[str]:
    """The fields of one record that may hold any line breaks."""
    out, field, at = [], _patterns(sep)[2], 0
    while True:
        m = field.match(text, at)
        quoted, rest, plain, end = m.groups()
        out.append(plain if quoted is None else quoted.replace('""', '"') + rest)
        if not end:
            return out
        at = m.end()


def _block_map(lines: pa.Table) -> pa.Table:
    """Where a piece ends, from outside and from inside, and whether a record ends in it from inside."""
    lines = lines.sort_by("at")
    sep = lines.column("sep")[0].as_py()
    outer, inner, closes = False, True, False
    for b in lines.column("line").to_pylist():
        if b'"' not in b:
            continue
        text, met = b.decode("latin-1"), outer == inner
        outer = ends_inside(text, sep, outer)
        inner = outer if met else ends_inside(text, sep, inner)
        closes = closes or not inner
    return pa.table({"file": lines.column("file")[:1], "block": lines.column("block")[:1], "chunk": lines.column("chunk")[:1],
                     "from_out": [outer], "from_in": [inner], "closes": [closes]})


def _begin(blocks: pa.Table) -> pa.Table:
    """For each piece of a file, the first line of the piece where the record open at its start began (NULL: none is open)."""
    blocks = blocks.sort_by([("block", "ascending"), ("start", "ascending")])
    since, open_since = [], None
    for start, outer, inner, closes in zip(*[blocks.column(c).to_pylist() for c in ("start", "from_out", "from_in", "closes")], strict=True):
        since.append(open_since)
        if outer is None:  # no quote in this piece
            continue
        if open_since is None:
            open_since = start if outer else None
        elif closes:
            open_since = start if inner else None
    return pa.table({**{c: blocks.column(c) for c in _PIECE}, "since": pa.array(since, pa.int64())})


_PARSED = "file string, block long, at long, fields array<string>, part binary, since long, sep string, utf8 boolean, start long"
_PARSED_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.int64())
_PARSED_NAMES = tuple(c.split()[0] for c in _PARSED.split(", "))


def _decode(raw: bytes, utf8: bool) -> str:
    return raw.decode("utf-8", errors="replace") if utf8 else raw.decode("latin-1")


def _parse_block(lines: pa.Table, begin: pa.Table) -> pa.Table:
    """Whole records of a piece, and the bytes of those that begin or end elsewhere."""
    lines = lines.sort_by("at")
    raw, places = lines.column("line").to_pylist(), lines.column("at").to_pylist()
    file, block, sep, utf8 = (lines.column(c)[0].as_py() for c in ("file", "block", "sep", "utf8"))
    since = begin.column("since")[0].as_py()
    inside, starts = since is not None, []
    for i, b in enumerate(raw):
        if not inside:
            starts.append(i)
        if b'"' in b:
            inside = ends_inside(b.decode("latin-1"), sep, inside)
    first = starts[0] if starts else len(raw)
    chunks = []

    def add(rows: list[tuple]) -> None:
        cols = list(zip(*rows, strict=True))
        chunks.append(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _PARSED_TYPES, strict=True)], names=_PARSED_NAMES))

    if first:
        add([(file, block, None, None, b"\n".join(raw[:first]) + b"\n", since, sep, utf8, places[0])])
    if inside and starts:
        last = starts.pop()
        add([(file, block, places[last], None, b"\n".join(raw[last:]) + b"\n", places[0], sep, utf8, places[0])])
        del raw[last:]
    starts.append(len(raw))
    for i in range(0, len(starts) - 1, _CHUNK):
        some = starts[i : i + _CHUNK + 1]
        texts = [_decode(b, utf8) for b in raw[some[0] : some[-1]]]
        if any("\r" in t[:-1] for t in texts):
            records: Iterable = (split_record("\n".join(texts[a - some[0] : b - some[0]]).removesuffix("\r"), sep) for a, b in zip(some, some[1:], strict=False))
        else:
            records = csv.reader((t + "\n" for t in texts), delimiter=sep)
        add([(file, block, places[a], fields, None, None, sep, utf8, None) for a, fields in zip(some[:-1], records, strict=True)])
    return pa.concat_tables(chunks) if chunks else pa.Table.from_arrays([pa.array([], t) for t in _PARSED_TYPES], names=_PARSED_NAMES)


def _join_parts(parts: pa.Table) -> pa.Table:
    """One record from the pieces that hold it."""
    parts = parts.sort_by([("block", "ascending"), ("start", "ascending")])
    raw = b"".join(parts.column("part").to_pylist()).removesuffix(b"\n").removesuffix(b"\r")
    sep, utf8, file, block = (parts.column(c)[0].as_py() for c in ("sep", "utf8", "file", "block"))
    at = next(a for a in parts.column("at").to_pylist() if a is not None)
    return pa.table({"file": [file], "block": [block], "at": [at], "fields": pa.array([split_record(_decode(raw, utf8), sep)], pa.list_(pa.string()))})


def _skip_names(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    name = F.lower(F.col("_metadata.file_name"))
    for p in parts:
        df = df.filter(~name.contains(p))
    return df


def _in_file_encoding(raw: Column) -> Column:
    return F.when(F.col("utf8"), raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))


def _split(text: Column, given: str | None) -> Column:
    """The fields of a line without quotes, by its file's delimiter."""
    if given is not None:
        return F.split(text, re.escape(given), -1)
    cut = F
    for sep in SEPARATORS:
        cut = cut.when(F.col("sep") == sep, F.split(text, re.escape(sep), -1))
    return cut


def store_lines(spark: SparkSession, paths: str | Sequence[str], base: str, recursive: bool = True,
                glob: str | None = None, skip_name_parts: Sequence[str] = ()) -> DataFrame:
    """Step 1: every line of the files as bytes, written once."""
    r = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    text = _skip_names(r.text(paths if isinstance(paths, str) else list(paths)), skip_name_parts)
    text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("line"),
        F.is_valid_utf8("value").alias("utf8"), F.contains("value", F.lit('"')).alias("quoted"),
    ).write.parquet(f"{base}/lines")
    return spark.read.parquet(f"{base}/lines")


def _chunk(at: Column) -> Column:
    return F.shiftright(at, PIECE_BITS)


def store_files(lines: DataFrame, base: str, sep: str | None = None, encoding: str | None = None) -> DataFrame:
    """Step 2: one row per file."""
    flags = lines.groupBy("file").agg(
        F.bool_and("utf8").alias("utf8"), F.bool_or("quoted").alias("quoted"),
        ((F.max("block") > 0) | (_chunk(F.max("at")) > _chunk(F.min("at")))).alias("many"),
        F.sum(F.octet_length("line") + 16).alias("size"),
        F.min(F.when(F.col("block") == 0, F.col("at"))).alias("first"))
    head = lines.select(F.col("file"), F.col("at").alias("first"), F.col("line").alias("head"))  # found by place: no sort by file
    files = flags.join(head, ["file", "first"])
    if encoding is not None:
        files = files.withColumn("utf8", F.lit(encoding.upper().replace("_", "-") in ("UTF-8", "UTF8")))
    text = F.rtrim(F.ltrim(_in_file_encoding(F.col("head")), F.lit("﻿")), F.lit("\r"))
    found = F.lit(SEPARATORS[0]) if sep is None else F.lit(sep)
    if sep is None:
        for s in reversed(SEPARATORS):
            found = F.when(F.contains(text, F.lit(s)), F.lit(s)).otherwise(found)
    files = files.select("file", "utf8", "quoted", "many", "size", "first", text.alias("head"), found.alias("sep"))
    files.write.parquet(f"{base}/files")
    return lines.sparkSession.read.parquet(f"{base}/files")


def _quoted_records(lines: DataFrame, files: DataFrame, base: str) -> DataFrame:
    """Step 4: (file, block, at, fields) of the files that have quotes."""
    some = files.filter("quoted").select("file", "utf8", "sep", "many")
    size, many = files.filter("quoted").agg(F.sum("size"), F.bool_or("many")).first()
    tasks = math.ceil(size / TASK_BYTES)
    lines = lines.withColumn("chunk", _chunk(F.col("at")))
    mine = lines.drop("utf8").join(some, "file")
    # a file of one piece begins outside
    begin = files.filter("quoted and not many").select(
        "file", F.lit(0).cast("long").alias("block"), _chunk(F.col("first")).alias("chunk"), F.lit(None).cast("long").alias("since"))
    if many:
        maps = mine.filter("quoted and many").select(*_PIECE, "at", "line", "sep").repartition(tasks, *_PIECE).groupBy(*_PIECE).applyInArrow(
            _block_map, "file string, block long, chunk long, from_out boolean, from_in boolean, closes boolean")
        blocks = lines.groupBy(*_PIECE).agg(F.min("at").alias("start")).join(some.filter("many").select("file"), "file")
        states = blocks.join(maps, _PIECE, "left").groupBy("file")
        begin = begin.union(states.applyInArrow(_begin, "file string, block long, chunk long, since long"))
    rows = mine.select(*_PIECE, "at", "line", "sep", "utf8").repartition(tasks, *_PIECE)
    (rows.groupBy(*_PIECE).cogroup(begin.groupBy(*_PIECE)).applyInArrow(_parse_block, _PARSED)
     .write.parquet(f"{base}/parsed"))
    parsed = lines.sparkSession.read.parquet(f"{base}/parsed")
    joined = parsed.filter("part is not null").groupBy("file", "since").applyInArrow(
        _join_parts, "file string, block long, at long, fields array<string>")
    return parsed.filter("part is null").select("file", "block", "at", "fields").union(joined)


def column_names(header: Sequence[str]) -> list[str]:
    """Names of a header's fields; unnamed and repeated ones are named by their place."""
    seen: set[str] = set()
    out = []
    for i, name in enumerate(header):
        name = name.lstrip("\ufeff").strip()
        name = name if name and name.lower() not in seen else f"_c{i}"
        seen.add(name.lower())
        out.append(name)
    return out


def store_records(spark: SparkSession, paths: str | Sequence[str], base: str, recursive: bool = True,
                  glob: str | None = None, skip_name_parts: Sequence[str] = (),
                  sep: str | None = None, encoding: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records (file, fields, layout; the header is none) and heads (file, layout, header), written under ``base``."""
    lines = store_lines(spark, paths, base, recursive, glob, skip_name_parts)
    files = store_files(lines, base, sep, encoding)
    layout = F.md5(F.array_join("header", "\x1f")).alias("layout")

    plain = files.filter("not quoted")
    plain_heads = plain.select("file", _split(F.col("head"), sep).alias("header")).select("file", layout, "header")
    parts = [plain_heads]
    body = lines.drop("utf8").join(plain.select("file", "utf8", "sep", "first"), "file")
    text = F.rtrim(_in_file_encoding(F.col("line")), F.lit("\r"))
    body = body.filter(~((F.col("block") == 0) & (F.col("at") == F.col("first")))).select("file", "sep", text.alias("text"))
    bodies = [body.filter("text <> ''").select("file", _split(F.col("text"), sep).alias("fields"))]

    if not files.filter("quoted").isEmpty():
        records = _quoted_records(lines, files, base)
        whose = files.filter("quoted").select("file", "first")
        marked = records.join(whose, "file").withColumn("is_head", (F.col("block") == 0) & (F.col("at") == F.col("first")))
        parts.append(marked.filter("is_head").select("file", F.col("fields").alias("header")).select("file", layout, "header"))
        rest = marked.filter(~F.col("is_head") & (F.size("fields") > 0))
        bodies.append(rest.filter(~((F.size("fields") == 1) & (F.element_at("fields", 1) == ""))).select("file", "fields"))

    heads = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    heads.write.parquet(f"{base}/heads")
    heads = spark.read.parquet(f"{base}/heads")
    body = bodies[0] if len(bodies) == 1 else bodies[0].union(bodies[1])
    stored = body.join(heads.select("file", "layout"), "file")
    stored.write.parquet(f"{base}/records")  # not by layout: that would sort
    return spark.read.schema("file string, fields array<string>, layout string").parquet(f"{base}/records"), heads


def record_frames(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True,
                  glob: str | None = None, skip_name_parts: Sequence[str] = (),
                  sep: str | None = None, encoding: str | None = None,
                  tolerant: bool = False, columns: Sequence[str] | None = None) -> list[DataFrame]:
    """All-text frames, one per distinct header, each with ``_source_path``.

    ``columns`` names the fields of every file by place instead of its header.
    ``tolerant`` drops records with more fields than names; short ones are
    filled with NULL in any case.
    """
    base = scratch_path(spark, f"records/{uuid.uuid4().hex}")
    records, heads = store_records(spark, paths, base, recursive, glob, skip_name_parts, sep, encoding)
    frames = []
    for layout, header in heads.select("layout", "header").distinct().orderBy("layout").collect():
        names = list(columns or column_names(header))
        rows = records.filter(F.col("layout") == layout)
        if tolerant:
            rows = rows.filter(F.size("fields") <= len(names))
        frames.append(rows.select(
            *[F.nullif(F.try_element_at("fields", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)],
            F.col("file").alias("_source_path")))
    return frames


def empty_frame(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
