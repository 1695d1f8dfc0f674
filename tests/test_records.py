"""Delimited files split over many tasks: the records of a one-task reader."""

import csv
import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tally.sources import records
from tally.sources.delimited import read_layouts, read_tolerant


@pytest.fixture()
def small_pieces(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(frames):
    out = []
    for f in frames:
        names = [c for c in f.columns if c != "_source_path"]
        out += [(os.path.basename(r["_source_path"]), *[(n, r[n]) for n in names]) for r in f.collect()]
    return sorted(out, key=repr)


def plain(name, text, sep):
    recs = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r and r != [""]]
    head = [h.strip() or f"_c{i}" for i, h in enumerate(recs[0])]
    return [(name, *[(h, (r[i] or None) if i < len(r) else None) for i, h in enumerate(head)]) for r in recs[1:]]


def test_states_and_fields_as_the_csv_module_has_them():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choices('a";\n é', weights=[4, 3, 3, 2, 1, 1], k=rng.randrange(24)))
        inside, starts = False, []
        for line in text.split("\n"):
            starts.append(not inside)
            inside = records.ends_inside(line, ";", inside)
        want = list(csv.reader(io.StringIO(text + "\n", newline=""), delimiter=";"))
        assert sum(starts) == len(want), text
        if sum(starts) == 1 and text:
            got = records.split_record(text, ";")
            assert got == want[0] or inside, text


def test_pieces_of_one_file_equal_one_task(spark, workdir, small_pieces):
    rng = random.Random(4)
    texts = {}
    for k, (sep, enc) in enumerate([(";", "latin-1"), (",", "utf-8"), ("\t", "utf-8"), (";", "utf-8")]):
        buf = io.StringIO(newline="")
        w = csv.writer(buf, delimiter=sep, lineterminator=rng.choice(["\n", "\r\n"]))
        w.writerow(["id", f"nota {k}", "valor"])
        for i in range(160):
            note = "".join(rng.choices(['a', 'é', '"', sep, "\n", "\r\n", " "], weights=[6, 2, 1, 1, 1, 1, 1], k=rng.choice([0, 5, 30, 900 if i % 47 == 0 else 9])))
            w.writerow([i, note, f"{i},5" if sep != "," else i])
        texts[f"f{k}.csv"] = (buf.getvalue(), sep, enc)
    plain_rows = "id;nota 9;valor\n" + "".join(f"{i};x é {i};\r\n" for i in range(60)) + "\n"
    texts["plain.csv"] = (plain_rows, ";", "latin-1")
    for name, (text, _, enc) in texts.items():
        with open(os.path.join(workdir, name), "wb") as f:
            f.write(text.encode(enc))
    got = rows_of(read_layouts(spark, workdir))
    want = sorted((r for name, (text, sep, _) in texts.items() for r in plain(name, text, sep)), key=repr)
    assert got == want


def test_a_file_is_read_by_many_tasks(spark, workdir, small_pieces):
    with open(os.path.join(workdir, "one.csv"), "w") as f:
        f.write("id;nota\n" + "".join(f'{i};"a\n{i}"\n' for i in range(3000)))
    base = os.path.join(workdir, "out")
    lines = records.store_lines(spark, os.path.join(workdir, "one.csv"), base)
    assert lines.select("block").distinct().count() > 20
    rows, heads = records.store_records(spark, os.path.join(workdir, "one.csv"), base + "2")
    assert rows.count() == 3000 and heads.count() == 1
    assert spark.read.parquet(base + "2/parsed").filter("part is not null").count() > 5


def test_a_field_longer_than_many_pieces(spark, workdir, small_pieces):
    long = "x\n" * 1500
    with open(os.path.join(workdir, "a.csv"), "w") as f:
        f.write(f'k;v\n1;"{long}"\n2;"y"\n3;"{long}"')
    (frame,) = read_layouts(spark, workdir)
    assert sorted((r.k, len(r.v)) for r in frame.collect()) == [("1", 3000), ("2", 1), ("3", 3000)]


def test_odd_files(spark, workdir, small_pieces):
    files = {"empty.csv": b"", "head.csv": b"a;b\n", "bom.csv": "﻿a;b\n1;é\n".encode(), "bom2.csv": '﻿"a";b\n1;"é"\n'.encode(),
             "dup.csv": b"a;A;;a\n1;2;3;4\n", "cr.csv": b'a;b\n"1\rx";y\n2\r2;"z"\n', "open.csv": b'a;b\n1;"never\nclosed', "wide.csv": b'"h\n1";b\n1;2;3\n4\n'}
    for name, data in files.items():
        with open(os.path.join(workdir, name), "wb") as f:
            f.write(data)
    got = {}
    for r in rows_of(read_layouts(spark, workdir)):
        got.setdefault(r[0], []).append(r[1:])
    assert got == {
        "bom.csv": [(("a", "1"), ("b", "é"))], "bom2.csv": [(("a", "1"), ("b", "é"))],
        "dup.csv": [(("a", "1"), ("_c1", "2"), ("_c2", "3"), ("_c3", "4"))],
        "cr.csv": [(("a", "1\rx"), ("b", "y")), (("a", "2\r2"), ("b", "z"))],
        "open.csv": [(("a", "1"), ("b", "never\nclosed"))],
        "wide.csv": [(("h\n1", "1"), ("b", "2")), (("h\n1", "4"), ("b", None))],
    }
    assert {tuple(f.columns[:-1]) for f in read_layouts(spark, workdir)} >= {("a", "b")}
    assert read_layouts(spark, os.path.join(workdir, "empty.csv")) == []


def test_tolerant_scan_counts_fields_of_whole_records(spark, workdir, small_pieces):
    text = 'K;V;W\n' + "".join(f'{i};"a;b\n""{i}""";{"NA" if i % 2 else "w"}\n{i};x;y;"too\nlong"\n{i}\n' for i in range(60))
    path = os.path.join(workdir, "t.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write(text)
    got = sorted((tuple(r) for r in read_tolerant(spark, path).collect()), key=repr)
    want = [(str(i), f'a;b\n"{i}"', None if i % 2 else "w") for i in range(60)] + [(str(i), None, None) for i in range(60)]
    assert got == sorted(want, key=repr)
    named = read_tolerant(spark, path, ["a", "b"])
    assert named.columns == ["a", "b"] and named.filter(F.col("b").isNull()).count() == 60 and named.count() == 60


def test_what_one_scan_task_reads_is_cut_by_lines(spark, workdir, monkeypatch):
    """A compressed file cannot be split by bytes; its lines still go to many small pieces."""
    monkeypatch.setattr(records, "PIECE_BITS", 4, raising=False)
    rows = [(str(i), "x\n" * 40 if i % 25 == 0 else f"a\n{i}") for i in range(300)]
    with gzip.open(os.path.join(workdir, "one.csv.gz"), "wt") as f:
        f.write("id;nota\n" + "".join(f'{i};"{note}"\n' for i, note in rows))
    base = os.path.join(workdir, "out")
    got, heads = records.store_records(spark, os.path.join(workdir, "one.csv.gz"), base)
    assert heads.count() == 1 and sorted(tuple(r.fields) for r in got.collect()) == sorted(rows)
    parsed = spark.read.parquet(base + "/parsed")
    assert parsed.filter("part is not null").count() > 20
    assert not [n for n in os.listdir(base + "/records") if n.startswith("layout=")]
