"""Spreadsheet scan (S9): the cells of a workbook's first sheet as text.

A cell's text is what a reader of typed cells would show, not what the file
stores: a number with a date format is a date and time, one with a clock
format below a day a time, one with an elapsed-hours format a duration; whole
numbers have no point, logical cells are ``True`` and ``False``, error cells
are NULL, as are empty ones. Which formats are dates is read from the style
table of the workbook (built-in numbers and format codes), and the day that
counting starts from the workbook's own setting.

One workbook is one task (a sheet is one compressed stream) and is read as a
stream, row by row; only its shared strings are held, as one run of bytes with
offsets, and a workbook with more than ``MAX_SHARED_BYTES`` of them is
reported. A damaged workbook gives one error row and no records.
"""

from __future__ import annotations

import datetime as dt
import re
import xml.etree.ElementTree as ET
import zipfile
from array import array
from collections.abc import Iterator

# The XML namespaces of the spreadsheet (OOXML) package parts.
_NS_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_NS_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_NS_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# Built-in number formats that are dates or times, and the elapsed one.
DATE_IDS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 47])
ELAPSED_IDS = frozenset([46])
MAX_SHARED_BYTES = 512 << 20

_ELAPSED = re.compile(r"\[(?:hh?|mm?|ss?)\]", re.IGNORECASE)
_NOT_CODE = re.compile(r'"[^"]*"|\[(?!hh?\]|mm?\]|ss?\])[^\]]*\]')  # literals, colours and locales
_DATE_LETTER = re.compile(r"(?<![_\\])[dmhys]", re.IGNORECASE)


def format_kind(code: str | None) -> str | None:
    """``elapsed``, ``date`` or None (a plain number) for a number format code."""
    first = (code or "").split(";")[0]
    if _ELAPSED.search(first):
        return "elapsed"
    return "date" if _DATE_LETTER.search(_NOT_CODE.sub("", first)) else None


def serial_text(value: float, kind: str, epoch: dt.datetime) -> str | None:
    """A day number as date, time or duration; NULL outside the calendar."""
    try:
        if kind == "elapsed":
            span = dt.timedelta(days=value)
            if span.microseconds:
                span = dt.timedelta(seconds=span.total_seconds() // 1, microseconds=round(span.microseconds, -3))
            return str(span)
        day, part = divmod(value, 1)
        clock = dt.timedelta(milliseconds=round(part * 86_400_000))
        if 0 <= value < 1 and not clock.days:
            return str((dt.datetime.min + clock).time())
        if 0 < value < 60 and epoch.year == 1899:  # the day that 1900 did not have
            day += 1
        return str(epoch + dt.timedelta(days=day) + clock)
    except (OverflowError, ValueError):
        return None


def number_text(text: str) -> str:
    """A stored number without a needless point."""
    value = float(text) if re.search(r"[.eE]", text) else int(text)
    return str(int(value)) if value == int(value) else str(value)


class SharedStrings:
    """The workbook's string table as one run of bytes."""

    def __init__(self, zf: zipfile.ZipFile):
        self.data, self.ends = bytearray(), array("Q", [0])
        if "xl/sharedStrings.xml" in zf.namelist():
            with zf.open("xl/sharedStrings.xml") as f:
                for el in _elements(f, "si"):
                    self.data += _rich_text(el).encode("utf-8", "surrogatepass")
                    self.ends.append(len(self.data))
                    if len(self.data) > MAX_SHARED_BYTES:
                        raise ValueError(f"shared strings over {MAX_SHARED_BYTES} bytes")

    def __getitem__(self, i: int) -> str:
        if i < 0:
            raise IndexError(i)
        return self.data[self.ends[i] : self.ends[i + 1]].decode("utf-8", "surrogatepass")


def _elements(stream, tag: str) -> Iterator[ET.Element]:
    """Complete elements of one name, each dropped from its parent after use."""
    path: list[ET.Element] = []
    for event, el in ET.iterparse(stream, events=("start", "end")):
        if event == "start":
            path.append(el)
            continue
        path.pop()
        if el.tag == _NS_MAIN + tag:
            yield el
            if path:
                path[-1].clear()


def _rich_text(el: ET.Element) -> str:
    """Text of a string item: its own, or that of its runs (not the reading aids)."""
    texts = [el.find(f"{_NS_MAIN}t"), *(r.find(f"{_NS_MAIN}t") for r in el.findall(f"{_NS_MAIN}r"))]
    return "".join(t.text or "" for t in texts if t is not None)


def _style_kinds(zf: zipfile.ZipFile) -> list[str | None]:
    """What each cell style makes of a number."""
    if "xl/styles.xml" not in zf.namelist():
        return []
    root = ET.fromstring(zf.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode") for f in root.iterfind(f"{_NS_MAIN}numFmts/{_NS_MAIN}numFmt")}
    out: list[str | None] = []
    for xf in root.iterfind(f"{_NS_MAIN}cellXfs/{_NS_MAIN}xf"):
        i = int(xf.get("numFmtId") or 0)
        if i in codes:
            out.append(format_kind(codes[i]))
        else:
            out.append("date" if i in DATE_IDS else "elapsed" if i in ELAPSED_IDS else None)
    return out


def column_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + (ord(ch.upper()) - 64)
    return n - 1


def _first_sheet(zf: zipfile.ZipFile) -> tuple[str, str, dt.datetime]:
    """Name and part of the first sheet, and the day from which days are counted."""
    book = ET.fromstring(zf.read("xl/workbook.xml"))
    sheet = book.find(f"{_NS_MAIN}sheets/{_NS_MAIN}sheet")
    rid = sheet.get(f"{_NS_REL}id")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.iter(f"{_NS_PKG}Relationship") if r.get("Id") == rid).lstrip("/")
    settings = book.find(f"{_NS_MAIN}workbookPr")
    mac = settings is not None and settings.get("date1904") in ("1", "true")
    epoch = dt.datetime(1904, 1, 1) if mac else dt.datetime(1899, 12, 30)
    return sheet.get("name"), target if target.startswith("xl/") else "xl/" + target, epoch


def _cell_text(cell: ET.Element, shared: SharedStrings, kinds: list[str | None], epoch: dt.datetime) -> str | None:
    kind, v = cell.get("t", "n"), cell.find(f"{_NS_MAIN}v")
    if kind == "inlineStr":
        inline = cell.find(f"{_NS_MAIN}is")
        return None if inline is None else _rich_text(inline) or None
    if v is None or v.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(v.text)] or None
    if kind == "b":
        return str(v.text.strip() in ("1", "true"))
    if kind == "d":
        return str(dt.datetime.fromisoformat(v.text.replace("Z", "")))
    if kind == "str":
        return v.text
    style = int(cell.get("s") or 0)
    as_date = kinds[style] if style < len(kinds) else None
    return serial_text(float(v.text), as_date, epoch) if as_date else number_text(v.text)


def sheet_records(zf: zipfile.ZipFile) -> Iterator[tuple[str, list[str | None]]]:
    """(sheet, cell texts) of each row of the first sheet; cells that are not stored are NULL."""
    shared, kinds = SharedStrings(zf), _style_kinds(zf)
    name, part, epoch = _first_sheet(zf)
    with zf.open(part) as f:
        for row in _elements(f, "row"):
            cells: dict[int, str | None] = {}
            for i, c in enumerate(row.iter(f"{_NS_MAIN}c")):
                ref = c.get("r")
                cells[column_index(ref) if ref else i] = _cell_text(c, shared, kinds, epoch)
            yield name, [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]
