"""Workbooks of typed cells, written by the tasks that hold the rows (the counterpart of the S9 scan)."""

from __future__ import annotations

import datetime as dt
import itertools
import uuid
import zipfile
from collections.abc import Iterator
from operator import itemgetter
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from ..sources.files import Output

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/>'
        f'<Relationship Id="rId2" Type="{_REL}/styles" Target="styles.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet {_MAIN}><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm:ss"/></numFmts>'
        '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>',
}
_EPOCH = dt.datetime(1899, 12, 30)


def _cell(v) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, dt.datetime):
        span = v.replace(tzinfo=None) - _EPOCH
        return f'<c s="2"><v>{span.days + (span.seconds + span.microseconds / 1e6) / 86400!r}</v></c>'
    if isinstance(v, dt.date):
        return f'<c s="1"><v>{(v - _EPOCH.date()).days}</v></c>'
    if isinstance(v, str):
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
    return f"<c><v>{v!r}</v></c>" if isinstance(v, (int, float)) else f"<c><v>{v}</v></c>"


def _write(batches: Iterator[pa.RecordBatch], folder: str, sheet: str) -> Iterator[pa.RecordBatch]:
    attempt, done = uuid.uuid4().hex[:8], []
    out = zf = part = current = None

    def close() -> None:
        nonlocal out, zf, part
        if out is not None:
            part.write(b"</sheetData></worksheet>")
            part.close()
            zf.close()
            out.__exit__(None, None, None)
            done.append(current)
            out = zf = part = None

    try:
        for batch in batches:
            names = batch.schema.names[1:]
            books = batch.column(0).to_pylist()
            rows = zip(books, zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True), strict=True)
            for book, run in itertools.groupby(rows, key=itemgetter(0)):
                if book != current:
                    close()
                    current, out = book, Output(f"{folder}/{book}", attempt)
                    zf = zipfile.ZipFile(out.__enter__(), "w", zipfile.ZIP_DEFLATED)
                    for name, text in _PARTS.items():
                        zf.writestr(name, text)
                    zf.writestr("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="{_REL}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>')
                    part = zf.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
                    part.write(f"<worksheet {_MAIN}><sheetData><row>{''.join(map(_cell, names))}</row>".encode())
                part.write("".join(f"<row>{''.join(map(_cell, values))}</row>" for _, values in run).encode())
        close()
    except BaseException as e:
        if out is not None:
            out.__exit__(type(e), e, None)
        raise
    yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["book"])


def write_workbooks(df: DataFrame, folder: str, book: Column, sheet: str = "Dados", partitions: int | None = None) -> int:
    """One workbook per value of ``book`` (a file name); returns their number.

    Numbers, dates, times, logical values and text become cells of their own
    kind. A workbook is written by one task as a stream.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.select(book.cast("string").alias("_book"), *df.columns).repartition(n, "_book").sortWithinPartitions("_book")
    return laid.mapInArrow(lambda batches: _write(batches, folder, sheet), "book string").count()
