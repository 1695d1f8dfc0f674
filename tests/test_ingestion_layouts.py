"""Loose files and archives of mixed shape give the same ledger."""

import os
import zipfile

from tally.plans.consolidate import canonical_ledger, canonical_registry, consolidate
from tally.sinks.tables import write_delimited
from tally.sources import archives, delimited

FILES = {
    "a.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL;NOTA\n100001;411;1.234,56;São Paulo\n".encode("latin-1"),
    "b.csv": b"VL_SALDO_FINAL;REG_ANS;CD_CONTA_CONTABIL\n20,00;100002;41\n",
    "c.csv": "CD_OPS,CD_CONTA_CONTABIL,VALOR\n100003,42,\"7,50\"\n".encode(),
    "d.csv": b"REG_ANS;CD_CONTA_CONTABIL\n100009;41\n",
}


def ledger(frames):
    shaped = [canonical_ledger(f, 2023, 1) for f in frames]
    return sorted((r.RegistroANS, float(r.ValorDespesas)) for r in consolidate(shaped).collect())


def test_layouts_in_one_folder(spark, workdir):
    loose, packed = os.path.join(workdir, "loose"), os.path.join(workdir, "zip")
    os.makedirs(loose)
    os.makedirs(packed)
    for name, data in FILES.items():
        with open(os.path.join(loose, name), "wb") as f:
            f.write(data)
    with zipfile.ZipFile(os.path.join(packed, "all.zip"), "w") as zf:
        for name, data in FILES.items():
            zf.writestr(name, data)
    want = [("100001", 1234.56), ("100002", 20.0), ("100003", 7.5)]
    assert ledger(delimited.read_layouts(spark, loose)) == want
    assert ledger(archives.parse_members(archives.archive_records(spark, packed))) == want


def test_archive_is_kept_or_reported_whole(spark, workdir):
    long = "x" * 200_000
    with zipfile.ZipFile(os.path.join(workdir, "good.zip"), "w") as zf:
        zf.writestr("a.csv", f"k;v\n1;{long}\n2;z\n")
    bad = os.path.join(workdir, "bad.zip")
    with zipfile.ZipFile(bad, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("a.csv", "k;v\n" + "1;2\n" * 1000)
        zf.writestr("b.csv", "k;v\n" + "".join(f"{i};{i * 7919}\n" for i in range(3000)))
    with open(bad, "r+b") as f:
        data = f.read()
        f.seek(data.index(b"b.csv") + 2000)
        f.write(b"\xff" * 200)
    rows = archives.archive_records(spark, workdir).collect()
    good = [r for r in rows if r.archive.endswith("good.zip")]
    assert [len(r.fields[1]) for r in good] == [1, 200_000, 1]
    damaged = [r for r in rows if r.archive.endswith("bad.zip")]
    assert len(damaged) == 1 and damaged[0].error


def test_registry_body_decides_encoding_and_quotes(spark, workdir):
    path = os.path.join(workdir, "registry.csv")
    with open(path, "wb") as f:
        f.write('REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;MODALIDADE;UF\n1;2;"Saúde ""A"" São";M;SP\n3;"x;y";"p;q";"r;s"\n'.encode("latin-1"))
    got = {r.RegistroANS: r for r in canonical_registry(delimited.read_tolerant(spark, path)).collect()}
    assert got["1"].RazaoSocial == 'Saúde "A" São'
    assert got["3"].RazaoSocial == "p;q" and got["3"].UF is None


def test_csv_round_trip_of_quotes(spark, workdir):
    out = os.path.join(workdir, "out")
    rows = [("a;b", 'say "hi"'), ("plain", "x\\y")]
    write_delimited(spark.createDataFrame(rows, "k string, v string"), out)
    back = spark.read.option("header", "true").option("sep", ";").option("escape", '"').csv(out)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    text = "\n".join(r.value for r in spark.read.text(out).collect())
    assert '"say ""hi"""' in text
