"""Delimited members in ZIP archives (K2, the counterpart of the S6 scan).

``member_lines`` turns rows into lines that know their archive and member;
``write_archives`` writes them, an archive in one task, as a stream: the rows
are sorted by archive and member, so that no archive is held in memory. Split
a large output over several archive names.
"""

from __future__ import annotations

import itertools
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import Output


def member_lines(df: DataFrame, archive: Column, member: Column, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """(archive, member, header, line): quotes are doubled and values quoted where needed."""
    options = {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}
    return df.select(
        archive.cast("string").alias("archive"), member.cast("string").alias("member"),
        F.lit(sep.join(columns)).alias("header"),
        F.to_csv(F.struct(*columns), options).alias("line"),
    )


def _write(batches: Iterator[pa.RecordBatch], folder: str, encoding: str) -> Iterator[pa.RecordBatch]:
    attempt, done = uuid.uuid4().hex[:8], []
    out = zf = entry = None
    at: tuple = (None, None)

    def close_entry() -> None:
        nonlocal entry
        if entry is not None:
            entry.close()
            entry = None

    def close_archive() -> None:
        nonlocal out, zf
        close_entry()
        if zf is not None:
            zf.close()
            out.__exit__(None, None, None)
            done.append(at[0])
            out = zf = None

    try:
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
            for (archive, member, header), run in itertools.groupby(rows, key=itemgetter(0, 1, 2)):
                if archive != at[0]:
                    close_archive()
                    out = Output(f"{folder}/{archive}", attempt)
                    zf = zipfile.ZipFile(out.__enter__(), "w", zipfile.ZIP_DEFLATED, allowZip64=True)
                if (archive, member) != at:
                    close_entry()
                    entry = zf.open(member, "w", force_zip64=True)
                    entry.write((header + "\n").encode(encoding))
                    at = (archive, member)
                entry.write("".join(f"{line}\n" for *_, line in run).encode(encoding))
        close_archive()
    except BaseException as e:
        if out is not None:
            out.__exit__(type(e), e, None)
        raise
    yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["archive"])


def write_archives(lines: DataFrame, folder: str, encoding: str = "utf-8", partitions: int | None = None) -> int:
    """Write every archive under ``folder``; returns their number."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = lines.select("archive", "member", "header", "line").repartition(n, "archive").sortWithinPartitions("archive", "member")
    return laid.mapInArrow(lambda batches: _write(batches, folder, encoding), "archive string").count()
