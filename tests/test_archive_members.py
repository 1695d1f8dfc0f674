"""ZIP archives read member by member: size, number, damage, and the sink that writes them."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tally.sinks.archives import member_lines, write_archives
from tally.sources import archives, files


def tasks_of(records):
    """Members, and the tasks that expanded them."""
    rows = records.filter("record_no = 0").select("member", F.spark_partition_id().alias("task")).collect()
    return len(rows), len({r.task for r in rows})


def test_members_of_one_archive_spread_over_tasks(spark, workdir):
    path = os.path.join(workdir, "many.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for i in range(1000):
            zf.writestr(f"d/{i}.csv", f"k;v\n{i};é{i}\n")
    records = archives.archive_records(spark, workdir)
    members, tasks = tasks_of(records)
    assert members == 1000 and tasks >= 8
    got = records.filter("record_no = 1").select(F.element_at("fields", 2)).collect()
    assert {r[0] for r in got} == {f"é{i}" for i in range(1000)}


def test_archive_over_two_gigabytes(spark, workdir):
    path = os.path.join(workdir, "large.zip")
    with open(path, "wb") as f:  # a hole in front: the directory at the end tells where the members are
        f.seek((2 << 30) + (1 << 20))
        with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as zf:
            for i in range(3):
                zf.writestr(f"{i}.csv", "k;v\n" + f"{i};x\n" * 1000)
    assert os.path.getsize(path) > 2 << 30
    records = archives.archive_records(spark, workdir)
    assert records.filter("error is null and record_no > 0").count() == 3000 and records.filter("error is not null").count() == 0


def test_same_records_as_the_whole_archive(spark, workdir, monkeypatch):
    text = 'a;b\n"x;""y""\r\nz";2\n\nlast;é'
    with zipfile.ZipFile(os.path.join(workdir, "m.zip"), "w") as zf:
        zf.writestr("stored.csv", text)
        zf.writestr("latin.csv", text.encode("latin-1"), zipfile.ZIP_BZIP2)
        zf.writestr("twice.csv", "k\n1\n")
        with pytest.warns(UserWarning):
            zf.writestr("twice.csv", "k\n2\n")
        zf.writestr("empty.csv", "")
        zf.writestr("Receita_1.csv", "no\n")
        zf.writestr("x.txt", "no\n")
    with zipfile.ZipFile(os.path.join(workdir, "none.zip"), "w") as zf:
        zf.writestr("x.txt", "no\n")
    with open(os.path.join(workdir, "broken.zip"), "wb") as f:
        f.write(b"PK not an archive")
    key = lambda r: (r.archive, r.member or "", r.record_no or 0, r.fields or [], r.encoding or "", r.error is not None)
    direct = sorted(map(key, archives.archive_records(spark, workdir).collect()))
    monkeypatch.setattr(archives, "DIRECT", ())
    whole = sorted(map(key, archives.archive_records(spark, workdir).collect()))
    assert direct == whole
    assert [r[3] for r in direct if r[1] == "twice.csv"] == [["k"], ["2"]]
    assert [r[3] for r in direct if r[1] == "stored.csv"] == [["a", "b"], ['x;"y"\r\nz', "2"], [], ["last", "é"]]
    assert [r for r in direct if r[5]][0][0].endswith("broken.zip")


def test_a_damaged_member_takes_its_archive_away(spark, workdir):
    path = os.path.join(workdir, "bad.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for i in range(50):
            zf.writestr(f"{i:02}.csv", "k;v\n" + "".join(f"{i};{j * 7919}\n" for j in range(500)))
    with open(path, "r+b") as f:
        f.seek(f.read().index(b"33.csv") + 600)
        f.write(b"\xff" * 40)
    rows = archives.archive_records(spark, workdir).collect()
    assert len(rows) == 1 and rows[0].error and rows[0].member is None


def test_written_archives_hold_the_rows(spark, workdir):
    rows = [(f"{i % 3}.zip", f"m{i % 2}.csv", f'v;"{i}"\n' if i % 5 == 0 else f" {i} ", i) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, m string, t string, n int").repartition(4)
    out = os.path.join(workdir, "out")
    assert write_archives(member_lines(df, F.col("a"), F.col("m"), ["t", "n"]), out) == 3
    assert sorted(os.listdir(out)) == ["0.zip", "1.zip", "2.zip"]
    got = archives.archive_records(spark, out).filter("record_no > 0").collect()
    assert sorted((r.archive[-5:], r.member, *r.fields) for r in got) == sorted((a, m, t, str(n)) for a, m, t, n in rows)


def test_an_interrupted_output_leaves_no_file(workdir):
    with pytest.raises(RuntimeError), files.Output(os.path.join(workdir, "x/y.bin"), "t") as stream:
        stream.write(b"half")
        raise RuntimeError
    assert os.listdir(os.path.join(workdir, "x")) == []
    with pytest.raises(ValueError):
        files.open_input("viewfs://store/a.zip")
