"""ZIP archive scan (S6) and spreadsheet scan.

Spark lists the archives; tasks read each archive's directory by range and
give one row per wanted member; the members are dealt over tasks again, and
each is inflated as a stream, once to check it and once to split it into
records with the C-implemented ``csv`` reader (quoted delimiters and quoted
line breaks are handled), one output row per record
``(archive, member, record_no, fields, encoding, error)``. A damaged archive
yields a single row carrying the error instead of failing the job. Column
naming per member layout is then a native projection of the ``fields`` array.

Limits: a member is one task (its compression can only be read in order); an
archive on storage without byte access is one task and at most 2 GB.
"""

from __future__ import annotations

import codecs
import csv
import io
import itertools
import lzma
import math
import uuid
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..session import scratch_path
from .delimited import SKIP_NAME_PARTS, sniff_dialect
from .files import DIRECT, open_input, scheme_of
from .workbooks import sheet_records

RECORDS_SCHEMA = StructType([
    StructField("archive", StringType()),
    StructField("member", StringType()),
    StructField("record_no", LongType()),
    StructField("fields", ArrayType(StringType())),
    StructField("encoding", StringType()),
    StructField("error", StringType()),
])
_COLUMNS = [f.name for f in RECORDS_SCHEMA.fields]
_CHUNK = 100_000  # records per Arrow batch handed back to the JVM
_CHUNK_CHARS = 16 << 20  # or so much text
TASK_BYTES = 64 << 20  # inflated bytes of members that one task takes
FILE_TASK_BYTES = 16 << 20  # bytes of files that one task takes


csv.field_size_limit(2**31 - 1)  # no field is too long for an archive


def _encoding(zf: zipfile.ZipFile, name: str | zipfile.ZipInfo) -> str:
    """UTF-8 if the whole member is; reads it in blocks, which also checks its data."""
    decoder, encoding = codecs.getincrementaldecoder("utf-8")(), "UTF-8"
    with zf.open(name) as f:
        while block := f.read(1 << 20):
            if encoding == "UTF-8":
                try:
                    decoder.decode(block)
                except UnicodeDecodeError:
                    encoding = "ISO-8859-1"
    if encoding == "UTF-8":
        try:
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            encoding = "ISO-8859-1"
    return encoding


def _member_wanted(name: str, extensions: Sequence[str], skip: Sequence[str]) -> bool:
    low = name.lower().rsplit("/", 1)[-1]
    return (any(low.endswith(e) for e in extensions) and not any(s in low for s in skip)
            and not name.endswith("/"))


def _records(zf: zipfile.ZipFile, name: str | zipfile.ZipInfo, encoding: str) -> Iterator[list[str]]:
    """Records of a member, streamed."""
    with zf.open(name) as f, io.TextIOWrapper(f, encoding=encoding, newline="") as text:
        first = text.readline()
        sep = sniff_dialect(first)["sep"]
        yield from csv.reader(itertools.chain([first], text) if first else [], delimiter=sep)


def _expand(batches: Iterator[pd.DataFrame], extensions, skip) -> Iterator[pd.DataFrame]:
    """Records of sound archives; one error row for an archive with any damaged member.

    All members are read through once before the first record goes out, so an
    archive is kept or reported as a whole.
    """
    out: list[tuple] = []
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                zf = zipfile.ZipFile(io.BytesIO(content))
                names = [n for n in dict.fromkeys(zf.namelist()) if _member_wanted(n, extensions, skip)]
                encodings = {n: _encoding(zf, n) for n in names}
                for n in names:
                    for _ in _records(zf, n, encodings[n]):
                        pass
            except (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, RuntimeError, NotImplementedError,
                    OSError, ValueError, csv.Error) as e:
                out.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
                continue
            for name in names:
                for i, rec in enumerate(_records(zf, name, encodings[name])):
                    out.append((path, name, i, rec, encodings[name], None))
                    if len(out) >= _CHUNK:
                        yield pd.DataFrame(out, columns=_COLUMNS)
                        out = []
    if out:
        yield pd.DataFrame(out, columns=_COLUMNS)


MEMBERS_SCHEMA = "archive string, entry int, member string, size long, encoding string, error string"
_DAMAGE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, RuntimeError, NotImplementedError, OSError, ValueError, KeyError)


def _rows(rows: list[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], list(names))


_MEMBER_NAMES = ("archive", "entry", "member", "size", "encoding", "error")
_MEMBER_TYPES = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string())
_RECORD_TYPES = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string())


class _Archives:
    """The archive opened last: a task reads its directory once for all members it has."""

    def __init__(self):
        self.path, self.zf = None, None

    def open(self, path: str) -> zipfile.ZipFile:
        if path != self.path:
            self.close()
            self.zf, self.path = zipfile.ZipFile(open_input(path)), path
        return self.zf

    def close(self) -> None:
        if self.zf is not None:
            self.zf.fp.close()
            self.zf.close()
        self.path = self.zf = None


def _list_members(batches: Iterator[pa.RecordBatch], extensions, skip) -> Iterator[pa.RecordBatch]:
    """Wanted members from each archive's directory, which lies at its end and is read alone."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            archives, out = _Archives(), []
            try:
                last = {info.filename: (i, info) for i, info in enumerate(archives.open(path).infolist())}  # as unpacking leaves it
                out = [(path, i, name, info.file_size, None, None) for name, (i, info) in last.items()
                       if _member_wanted(name, extensions, skip)]
            except _DAMAGE as e:
                out = [(path, None, None, None, None, f"{type(e).__name__}: {e}")]
            archives.close()
            for i in range(0, len(out), _CHUNK):
                yield _rows(out[i : i + _CHUNK], _MEMBER_NAMES, _MEMBER_TYPES)


def _check_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member inflated once as a stream: its checksum holds, and the encoding it is in."""
    archives = _Archives()
    for batch in batches:
        out = []
        for path, entry, member, size in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            try:
                zf = archives.open(path)
                out.append((path, entry, member, size, _encoding(zf, zf.infolist()[entry]), None))
            except _DAMAGE as e:
                out.append((path, entry, member, size, None, f"{type(e).__name__}: {e}"))
        yield _rows(out, _MEMBER_NAMES, _MEMBER_TYPES)
    archives.close()


def _expand_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each member, inflated and split as a stream."""
    archives = _Archives()
    for batch in batches:
        for path, entry, member, _, encoding, _ in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            zf = archives.open(path)
            out, size = [], 0
            for i, fields in enumerate(_records(zf, zf.infolist()[entry], encoding)):
                out.append((path, member, i, fields, encoding, None))
                size += sum(map(len, fields))
                if len(out) >= _CHUNK or size >= _CHUNK_CHARS:
                    yield _rows(out, _COLUMNS, _RECORD_TYPES)
                    out, size = [], 0
            if out:
                yield _rows(out, _COLUMNS, _RECORD_TYPES)
    archives.close()


def _files(spark: SparkSession, paths: str | Sequence[str], glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(paths if isinstance(paths, str) else list(paths)))


def _direct(files: DataFrame) -> bool:
    """Whether tasks can read parts of all these files."""
    schemes = files.select(F.regexp_extract("path", "^[^:]+:/", 0)).distinct().collect()
    return {scheme_of(r[0]) for r in schemes} <= set(DIRECT)


def archive_members(spark: SparkSession, paths: str | Sequence[str],
                    extensions: Sequence[str] = (".csv",),
                    skip_name_parts: Sequence[str] = SKIP_NAME_PARTS,
                    glob: str = "*.[zZ][iI][pP]") -> DataFrame:
    """One checked row per wanted member (archive, entry, member, size, encoding, error),
    or one with the error per archive whose directory cannot be read.

    The directories are read by range in the tasks; then the members, however
    many an archive has, are dealt over tasks by themselves, and each is
    inflated once to check it. The rows are written to the shared scratch
    folder, as both the errors and the records follow from them.
    """
    ext, skip = tuple(extensions), tuple(skip_name_parts)
    listing = _files(spark, paths, glob).select("path", "length")  # no content column: files are listed, not read
    base = scratch_path(spark, f"archives/{uuid.uuid4().hex}")
    (_spread(listing).mapInArrow(lambda it: _list_members(it, ext, skip), MEMBERS_SCHEMA)
     .write.parquet(f"{base}/listed"))
    listed = spark.read.parquet(f"{base}/listed")
    sound = listed.filter(F.col("error").isNull())
    checked = _dealt(sound).mapInArrow(_check_members, MEMBERS_SCHEMA)
    checked.union(listed.filter(F.col("error").isNotNull())).write.parquet(f"{base}/checked")
    return spark.read.parquet(f"{base}/checked")


def _spread(files: DataFrame) -> DataFrame:
    """Files (path, length) dealt over tasks in turn, so that no task has more than its share of
    them; the number is given, or small listings would be merged into one task."""
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, max(4 * cores, math.ceil(size / FILE_TASK_BYTES))))
    place = F.row_number().over(Window.orderBy(F.desc("length"), "path")) - 1  # a row a file
    return files.select("path", (place % tasks).alias("task")).repartitionByRange(tasks, "task").select("path")


def _dealt(members: DataFrame) -> DataFrame:
    """Members over tasks: one for about ``TASK_BYTES``, and no fewer than members or twice the cores ask for."""
    n, size = members.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cores = members.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, math.ceil(size / TASK_BYTES), min(n, 2 * cores))
    return members.repartition(tasks, "archive", "entry").sortWithinPartitions("archive", "entry")


def archive_records(spark: SparkSession, paths: str | Sequence[str],
                    extensions: Sequence[str] = (".csv",),
                    skip_name_parts: Sequence[str] = SKIP_NAME_PARTS,
                    glob: str = "*.[zZ][iI][pP]") -> DataFrame:
    """One row per delimited record of every wanted member of every archive.

    Members, not archives, are the unit of work, so neither an archive's size
    nor its number of members bounds the parallelism; a member is read as a
    stream. An archive with any damaged member gives one error row and no
    records. Where the storage has no byte access (``files.DIRECT``), an
    archive is one value of one task, up to the 2 GB of such a value.
    """
    ext, skip = tuple(extensions), tuple(skip_name_parts)
    if not _direct(_files(spark, paths, glob)):
        return _files(spark, paths, glob).select("path", "content").mapInPandas(
            lambda it: _expand(it, ext, skip), RECORDS_SCHEMA)
    members = archive_members(spark, paths, extensions, skip_name_parts, glob)
    bad = members.filter(F.col("error").isNotNull()).groupBy("archive").agg(F.min("error").alias("error"))
    good = _dealt(members.join(bad, "archive", "left_anti"))
    none = {"member": "string", "record_no": "long", "fields": "array<string>", "encoding": "string"}
    errors = bad.select("archive", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "error")
    return good.mapInArrow(_expand_members, RECORDS_SCHEMA).union(errors)


def parse_members(records: DataFrame) -> list[DataFrame]:
    """All-text frames, one per distinct header layout across all members.

    Every data record is joined to its own member's header (one small row
    per member file), and each layout is one array-equality filter, so the
    plan does not grow with the number of files. Only the distinct headers
    (a handful of layouts) reach the driver; data rows never do. Each frame
    carries ``_source_path`` (``archive!member``); short records give NULLs
    for the missing fields, and so do empty ones. Pass a written (materialised) records table when
    there are several layouts, so the Python expansion is not repeated per
    layout.
    """
    heads = records.filter((F.col("record_no") == 0) & F.col("error").isNull()).select(
        "archive", "member", F.col("fields").alias("_header"))
    layouts = [tuple(r[0]) for r in heads.select("_header").distinct().collect()]
    body = records.filter((F.col("record_no") > 0) & F.col("error").isNull()
                          & (F.size("fields") > 0)).join(heads, ["archive", "member"])
    frames = []
    for header in layouts:
        names = [h.strip() for h in header]
        same = F.col("_header") == F.array(*[F.lit(h) for h in header])
        frames.append(body.filter(same).select(
            *[F.nullif(F.try_element_at("fields", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)],
            F.concat(F.col("archive"), F.lit("!"), F.col("member")).alias("_source_path"),
        ))
    return frames


def archive_errors(records: DataFrame) -> DataFrame:
    """Archives that could not be read, with the error text."""
    return records.filter(F.col("error").isNotNull()).select("archive", "error")


_SHEET_DAMAGE = (*_DAMAGE, IndexError, AttributeError, StopIteration, ET.ParseError)


def _expand_sheets(books: Iterator[tuple[str, BinaryIO]]) -> Iterator[pa.RecordBatch]:
    """Records of workbooks, read once; a damaged one ends in an error row, after the records before the damage."""
    for path, handle in books:
        out, size = [], 0
        try:
            with zipfile.ZipFile(handle) as zf:
                for i, (sheet, fields) in enumerate(sheet_records(zf)):
                    out.append((path, sheet, i, fields, None, None))
                    size += sum(len(c) for c in fields if c)
                    if len(out) >= _CHUNK or size >= _CHUNK_CHARS:
                        yield _rows(out, _COLUMNS, _RECORD_TYPES)
                        out, size = [], 0
        except _SHEET_DAMAGE as e:
            out = [(path, None, None, None, None, f"{type(e).__name__}: {e}")]
        if out:
            yield _rows(out, _COLUMNS, _RECORD_TYPES)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, BinaryIO]]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open_input(path) as f:
                yield path, f


def _loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, BinaryIO]]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield path, io.BytesIO(content.as_py())


def read_spreadsheets(spark: SparkSession, paths: str | Sequence[str],
                      skip_name_parts: Sequence[str] = SKIP_NAME_PARTS) -> DataFrame:
    """Records of the first sheet of every ``.xlsx`` (S9), same shape as
    :func:`archive_records` (``member`` = sheet name), so
    :func:`parse_members` names the columns from the header row.

    Cells become text as :mod:`tally.sources.workbooks` says: dates, times and
    logical values by their kind, numbers without a needless point. Each
    workbook is read once, by one task; the records are written to the shared
    scratch folder, and those of a damaged workbook are left out from there.
    """
    files = _files(spark, paths, "*.[xX][lL][sS][xX]")
    name = F.lower(F.element_at(F.split(F.col("path"), "/"), -1))
    for part in skip_name_parts:
        files = files.filter(~name.contains(part))
    if _direct(files):
        read = _spread(files.select("path", "length")).mapInArrow(lambda it: _expand_sheets(_opened(it)), RECORDS_SCHEMA)
    else:
        read = files.select("path", "content").mapInArrow(lambda it: _expand_sheets(_loaded(it)), RECORDS_SCHEMA)
    base = scratch_path(spark, f"sheets/{uuid.uuid4().hex}")
    read.write.parquet(base)
    read = spark.read.schema(RECORDS_SCHEMA).parquet(base)
    bad = read.filter(F.col("error").isNotNull()).select("archive")
    return read.filter(F.col("error").isNull()).join(bad, "archive", "left_anti").select(_COLUMNS).union(
        read.filter(F.col("error").isNotNull()))
