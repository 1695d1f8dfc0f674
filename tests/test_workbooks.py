"""Text of typed spreadsheet cells."""

import datetime as dt
import glob
import os
import zipfile

import pytest

from tally.plans import suite
from tally.sources import archives, workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
CODES = ['yyyy-mm-dd', '[h]:mm', '"dia" 0.00', '[Red]0', '[$-416]d" de "mmm', r'0\d', 'General;dd', 'hh:mm AM/PM', '0.00_);h']
KINDS = ["date", "elapsed", None, None, "date", None, None, "date", None]


def book(path, cells, mac=False, shared=()):
    xfs = "".join(f'<xf numFmtId="{i}"/>' for i in (0, 14, 22, 46, 10, *range(164, 164 + len(CODES))))
    fmts = "".join(f'<numFmt numFmtId="{164 + i}" formatCode="{c.replace(chr(34), "&quot;")}"/>' for i, c in enumerate(CODES))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}"><workbookPr date1904="{int(mac)}"/><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="/xl/worksheets/s.xml"/></Relationships>')
        zf.writestr("xl/styles.xml", f"<styleSheet {MAIN}><numFmts>{fmts}</numFmts><cellStyleXfs><xf numFmtId=\"14\"/></cellStyleXfs><cellXfs>{xfs}</cellXfs></styleSheet>")
        zf.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(f'<si>{s}</si>' for s in shared)}</sst>")
        rows = "".join(f"<row>{''.join(r)}</row>" for r in cells)
        zf.writestr("xl/worksheets/s.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")


def n(v, s=0):
    return f'<c s="{s}"><v>{v}</v></c>'


CASES = [
    (n(5), "5"), (n("5.0"), "5"), (n("1.1000000000000001"), "1.1"), (n("1E+16"), "10000000000000000"), (n("-0.25"), "-0.25"), (n("12345678901234567"), "12345678901234567"),
    (n(44957, 1), "2023-01-31 00:00:00"), (n("44957.5", 2), "2023-01-31 12:00:00"), (n("0.75", 2), "18:00:00"), (n(1, 1), "1900-01-01 00:00:00"), (n(60, 1), "1900-02-28 00:00:00"),
    (n(61, 1), "1900-03-01 00:00:00"), (n("44957.000005787", 2), "2023-01-31 00:00:00.500000"), (n("1.5", 3), "1 day, 12:00:00"), (n("0.1", 4), "0.1"), (n("9999999", 1), None), (n("-1", 1), "1899-12-29 00:00:00"),
    (n(44957, 5), "2023-01-31 00:00:00"), (n("0.5", 6), "12:00:00"), (n(3, 7), "3"), (n(3, 8), "3"), (n(2, 9), "1900-01-02 00:00:00"), (n(7, 10), "7"), (n(7, 11), "7"), (n("0.5", 12), "12:00:00"),
    ('<c t="b"><v>1</v></c>', "True"), ('<c t="b"><v>0</v></c>', "False"), ('<c t="e"><v>#N/A</v></c>', None), ('<c t="d"><v>2023-01-31T10:00:00Z</v></c>', "2023-01-31 10:00:00"),
    ('<c t="str"><f>A1</f><v> x </v></c>', " x "), ('<c t="s"><v>0</v></c>', "Ação"), ('<c t="s"><v>1</v></c>', "rich text"), ('<c t="s"><v>2</v></c>', None), ("<c/>", None),
    ('<c t="inlineStr"><is><t>in</t></is></c>', "in"), ('<c t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c>', "ab"),
]
SHARED = ["<t>Ação</t>", "<r><t>rich </t></r><r><t>text</t></r><rPh><t>no</t></rPh>", "<t></t>"]


def test_cell_texts(spark, workdir):
    book(os.path.join(workdir, "a.xlsx"), [[c] for c, _ in CASES], shared=SHARED)
    rows = sorted(archives.read_spreadsheets(spark, workdir).collect(), key=lambda r: r.record_no)
    assert [r.fields[0] for r in rows] == [t for _, t in CASES] and {r.member for r in rows} == {"S"}


def test_format_codes():
    assert [workbooks.format_kind(c) for c in CODES] == KINDS
    assert workbooks.serial_text(0, "date", dt.datetime(1904, 1, 1)) == "00:00:00"


def test_other_calendar_gaps_and_damage(spark, workdir, monkeypatch):
    book(os.path.join(workdir, "mac.xlsx"), [['<c r="B1" s="1"><v>1</v></c>', '<c r="AA1"><v>2</v></c>'], []], mac=True)
    book(os.path.join(workdir, "bad.xlsx"), [['<c t="s"><v>9</v></c>']])
    book(os.path.join(workdir, "Receita.xlsx"), [[n(1)]])
    book(os.path.join(workdir, "torn.xlsx"), [["<c><v>1"]])
    with open(os.path.join(workdir, "no.xlsx"), "wb") as f:
        f.write(b"not a workbook")

    def check():
        rows = {}
        for r in archives.read_spreadsheets(spark, workdir).collect():
            rows.setdefault(r.archive.rsplit("/", 1)[1], []).append(r)
        assert sorted(rows) == ["bad.xlsx", "mac.xlsx", "no.xlsx", "torn.xlsx"]
        assert all(len(rows[k]) == 1 and rows[k][0].error for k in ("bad.xlsx", "no.xlsx", "torn.xlsx"))
        assert sorted(r.fields for r in rows["mac.xlsx"]) == [[], [None, "1904-01-02 00:00:00", *[None] * 24, "2"]]

    check()
    monkeypatch.setattr(archives, "DIRECT", ())
    check()


def test_shared_strings_are_bounded(workdir, monkeypatch):
    path = os.path.join(workdir, "a.xlsx")
    book(path, [['<c t="s"><v>1</v></c>']], shared=["<t>aaaa</t>", "<t>éé</t>"])
    with zipfile.ZipFile(path) as zf:
        shared = workbooks.SharedStrings(zf)
        assert (shared[0], shared[1]) == ("aaaa", "éé") and len(shared.data) == 8
        monkeypatch.setattr(workbooks, "MAX_SHARED_BYTES", 7)
        with pytest.raises(ValueError):
            workbooks.SharedStrings(zf)


def test_every_workbook_has_a_task_and_damage_far_down_leaves_no_records(spark, workdir):
    for k in range(6):
        book(os.path.join(workdir, f"b{k}.xlsx"), [[n(k)], [n(k + 1)]])
    out = archives.read_spreadsheets(spark, workdir)
    assert sorted(r.fields[0] for r in out.collect()) == sorted(str(k + i) for k in range(6) for i in (0, 1))
    assert len([f for f in out.inputFiles() if f.endswith(".parquet")]) == 6  # one written part a task
    book(os.path.join(workdir, "late.xlsx"), [*[[n(1)]] * (archives._CHUNK + 10), ["<c><v>1"]])
    late = archives.read_spreadsheets(spark, os.path.join(workdir, "late.xlsx")).collect()
    assert len(late) == 1 and late[0].error and late[0].fields is None


def test_workbooks_and_archives_grow_in_number_with_the_rows(spark, workdir, monkeypatch):
    monkeypatch.setattr(suite, "SHEET_ROWS", 3, raising=False)
    monkeypatch.setattr(suite, "ARCHIVE_ROWS", 4, raising=False)
    day = dt.date(1995, 2, 3)
    orders = [(i, 1.5 * i, "O" if i % 3 else "F", day, "1-URGENT") for i in range(90)]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderstatus string, o_orderdate date, o_orderpriority string").write.parquet(f"{workdir}/orders.parquet")
    items = [(i // 7, i % 7 + 1, i, i % 5, 10.25 * (i + 1), day) for i in range(70)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate date").write.parquet(f"{workdir}/lineitem.parquet")
    folders = []
    monkeypatch.setattr(suite, "scratch_folder", lambda spark, key: folders.append(f"{workdir}/{key}{len(folders)}") or folders[-1])
    got = sorted((int(r.chave), r.total, r.aberto) for r in suite.s09_spreadsheet(spark, workdir).collect())
    assert got == [(i, t, str(s == "O")) for i, t, s, *_ in orders]
    assert len(glob.glob(f"{folders[0]}/*/livro.xlsx")) == 30
    folders.clear()
    got = sorted(tuple(r) for r in suite.s06_archives(spark, workdir).collect())
    assert got == sorted(tuple(r) for r in suite.QUERIES["r09_consolidate"](spark, workdir).collect())
    assert len(glob.glob(f"{folders[0]}/1995_T1/*.zip")) > 10
