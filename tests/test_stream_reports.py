"""What a stream cannot take is reported by batch."""

import os
import zipfile

from tally.streaming import ingest

HEAD = "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n"


def test_rejected_amounts_of_a_file_stream(spark, workdir):
    landing, target = os.path.join(workdir, "in/2023_T1"), os.path.join(workdir, "out")
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write(HEAD + "1;41;10,00\n2;41;99999999999999999,00\n3;41;-5,00\n4;41;x\n")
    columns = ["REG_ANS", "CD_CONTA_CONTABIL", "VL_SALDO_FINAL"]
    ingest.start_ingest(spark, os.path.join(workdir, "in"), target, columns, name=os.path.basename(workdir)).awaitTermination(120)
    assert [(r.RegistroANS, float(r.ValorDespesas)) for r in spark.read.parquet(target).collect()] == [("1", 10.0)]
    bad = spark.read.parquet(ingest.rejected_path(target)).collect()
    assert [(r.RegistroANS, r.Ano, r.Trimestre, r.ValorTexto) for r in bad] == [("2", 2023, 1, "99999999999999999,00")]


def test_unreadable_archives_of_an_archive_stream(spark, workdir):
    landing, target = os.path.join(workdir, "in/2023_T2"), os.path.join(workdir, "out")
    os.makedirs(landing)
    with zipfile.ZipFile(f"{landing}/a.zip", "w") as zf:
        zf.writestr("a.csv", HEAD + "1;41;10,00\n2;41;99999999999999999,00\n")
    with open(f"{landing}/bad.zip", "wb") as f:
        f.write(b"no archive")
    ingest.start_archive_ingest(spark, os.path.join(workdir, "in"), target, name=os.path.basename(workdir)).awaitTermination(120)
    assert [r.RegistroANS for r in spark.read.parquet(target).collect()] == ["1"]
    errors = spark.read.parquet(ingest.errors_path(target)).collect()
    assert len(errors) == 1 and errors[0].archive.endswith("bad.zip") and errors[0].error
    assert [r.RegistroANS for r in spark.read.parquet(ingest.rejected_path(target)).collect()] == ["2"]
