"""Refresh of several tables as one step, lookups that skip row groups, order of an export."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tally.operators.ordering import asc, desc, ranked
from tally.plans.serving import expense_history, operator_detail
from tally.sinks.snapshots import Snapshots, open_table
from tally.sinks.tables import write_delimited, write_fact, write_lookup
from tally.sources.delimited import read_ranked


def refresh(snapshots, spark, value, tables=("dimension", "fact", "mart"), stop_after=None):
    version = snapshots.begin()
    for i, t in enumerate(tables):
        if stop_after == i:
            raise RuntimeError("stopped")
        spark.createDataFrame([(value, t)], "v int, t string").write.parquet(version.table(t))
    return snapshots.commit(version, tables)


def seen(spark, base):
    return {t: open_table(spark, base, t).first().v for t in ("dimension", "fact", "mart")}


def test_a_refresh_stopped_between_tables_changes_nothing(spark, workdir):
    snapshots = Snapshots(spark, workdir)
    assert snapshots.current() is None
    with pytest.raises(FileNotFoundError):
        snapshots.read("fact")
    assert refresh(snapshots, spark, 1) == 1
    held = snapshots.read("fact")
    for stop in (1, 2):
        with pytest.raises(RuntimeError):
            refresh(snapshots, spark, 9, stop_after=stop)
        assert seen(spark, workdir) == {"dimension": 1, "fact": 1, "mart": 1}
    half = snapshots.begin()
    held.write.parquet(half.table("fact"))
    with pytest.raises(ValueError):
        snapshots.commit(half, ["fact", "mart"])
    assert refresh(snapshots, spark, 2) == 2
    assert seen(spark, workdir) == {"dimension": 2, "fact": 2, "mart": 2}
    assert held.first().v == 1 and snapshots.read("fact", 1).first().v == 1
    with pytest.raises(KeyError):
        snapshots.read("other")


def test_a_refresh_that_dies_in_its_commit(spark, workdir):
    snapshots = Snapshots(spark, workdir)
    refresh(snapshots, spark, 1)
    os.makedirs(os.path.join(workdir, "_manifests"), exist_ok=True)
    for name in ("2.claim", "2.part"):  # claimed and half written, never renamed
        with open(os.path.join(workdir, "_manifests", name), "w") as f:
            f.write('{"path"')
    assert seen(spark, workdir)["fact"] == 1
    assert refresh(snapshots, spark, 3) == 3 and snapshots.numbers() == [1, 3]
    assert seen(spark, workdir)["mart"] == 3
    assert snapshots.expire(keep=1) == [1] and snapshots.numbers() == [3] and seen(spark, workdir)["fact"] == 3


def test_two_refreshes_at_a_time_get_two_numbers(spark, workdir):
    got = []
    tasks = [threading.Thread(target=lambda v=v: got.append(refresh(Snapshots(spark, workdir), spark, v))) for v in range(4)]
    for t in tasks:
        t.start()
    for t in tasks:
        t.join()
    assert sorted(got) == [1, 2, 3, 4] and len(set(seen(spark, workdir).values())) == 1


def rows_read(df):
    """Rows that the file scans of a finished query handed on."""
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    stack = [plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    while stack:
        p = stack.pop()
        p = p.plan() if "QueryStage" in p.nodeName() else p
        if p.nodeName().startswith("Scan "):
            total += p.metrics().apply("numOutputRows").value()
        children = p.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_lookups_skip_row_groups(spark, workdir):
    n = 40_000
    # tax ids in an order of their own, so that a row group's least and largest say nothing
    dim = spark.range(n).select(
        F.col("id").alias("registro_ans"), F.lpad(F.expr("(id * 7919) % 1000003").cast("string"), 14, "0").alias("cnpj_digits"),
        F.lit("name").alias("razao_social"), F.lit("SP").alias("uf"), F.lit("m").alias("modalidade"))
    dim = dim.withColumn("cnpj", F.col("cnpj_digits"))
    path = os.path.join(workdir, "dim")
    write_lookup(dim, path, ["registro_ans", "cnpj_digits"], partitions=2, row_group_bytes=40_000)
    stored = spark.read.parquet(path)
    want = dim.filter("registro_ans = 777").first()
    hit = operator_detail(stored, want.cnpj)
    assert hit.collect()[0].registro_ans == 777 and 0 < rows_read(hit) < n / 4
    none = stored.filter(F.col("cnpj_digits") == "09999999999999")
    assert none.collect() == [] and rows_read(none) < n / 4
    fact = spark.range(4 * n).select(
        F.expr("(id * 104729) % 40009").alias("registro_ans"), F.lit(2023).alias("ano"), F.lit(1).alias("trimestre"),
        F.to_date(F.lit("2023-01-01")).alias("data_referencia"), (F.col("id") / 7).cast("decimal(15,2)").alias("valor_despesa"))
    write_fact(fact, path + "_fact", partitions=2, row_group_bytes=40_000)
    stored_fact = spark.read.parquet(path + "_fact")
    history = expense_history(stored_fact, stored, want.cnpj)
    assert sorted(r.valor_despesa for r in history.collect()) == sorted(float(r[0]) for r in fact.filter("registro_ans = 777").select("valor_despesa").collect())
    assert 0 < rows_read(history) < 4 * n / 4


def test_place_of_each_row_of_an_export(spark, workdir):
    df = spark.range(5000).select("id", (F.expr("(id * 7919) % 613") / 4).alias("v")).repartition(7)
    for compression in (None, "gzip"):
        path = os.path.join(workdir, str(compression))
        write_delimited(ranked(df, [desc("v"), asc("id")]), path, compression=compression)
        got = {r.pos: r.id for r in read_ranked(spark, path, "id long, v double").collect()}
        want = sorted(df.collect(), key=lambda r: (-r.v, r.id))
        assert got == {i + 1: r.id for i, r in enumerate(want)}
