"""A key holding a third of all rows: results equal a brute-force computation,
and the aggregations reduce it map-side (partial aggregates in the plan)."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tally.operators import aggregates, sets, windows

SCHEMA = "registro_ans bigint, ano int, trimestre int, data_referencia date, valor_despesa decimal(15,2)"


def make_rows(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 60)  # key 0: one third of the rows
        t = rnd.randrange(1, 5)
        v = Decimal(rnd.randrange(1, 100000)) / 100
        rows.append((key, 2023, t, dt.date(2023, (t - 1) * 3 + 1, 1), v))
    return rows


def test_hot_key_aggregates_match_brute_force(spark):
    rows = make_rows()
    fact = spark.createDataFrame(rows, SCHEMA).repartition(8)
    total = defaultdict(Decimal)
    first = {}
    for k, _, _, d, v in rows:
        total[k] += v
        cur = first.get(k)
        if cur is None or (d, v) < cur:
            first[k] = (d, v)
    got = {r[0]: r[1] for r in fact.groupBy("registro_ans").agg(F.sum("valor_despesa")).collect()}
    assert got == dict(total)
    fl = {r[0]: r[1] for r in windows.first_last(fact, "registro_ans", "data_referencia",
                                                 "valor_despesa").collect()}
    assert fl == {k: v for k, (_, v) in first.items()}
    kept = {r[0]: r[2] for r in sets.keep_first(
        fact.select("registro_ans", "data_referencia", "valor_despesa"), ["registro_ans"],
        ["data_referencia", "valor_despesa"]).collect()}
    assert kept == {k: v for k, (_, v) in first.items()}


def test_hot_key_above_mean(spark):
    rows = make_rows(seed=5)
    fact = spark.createDataFrame(rows, SCHEMA).repartition(8)
    s, n = defaultdict(Decimal), defaultdict(int)
    for _, a, t, _, v in rows:
        s[(a, t)] += v
        n[(a, t)] += 1
    above = defaultdict(int)
    quarters = defaultdict(set)
    for k, a, t, _, v in rows:
        if v * n[(a, t)] > s[(a, t)]:
            above[k] += 1
            quarters[k].add((a, t))
    got = {r[0]: (r[1], r[2]) for r in aggregates.above_period_mean(fact).collect()}
    want = {k: (above.get(k, 0), len(quarters.get(k, ()))) for k in got}
    assert got == want


def test_hot_key_enrichment_does_not_shuffle_the_ledger(spark, workdir):
    from tally.plans.mart import enriched_ledger

    rows = [("0" if i % 3 == 0 else str(i % 50), 2023, 1, Decimal(i % 997) / 100) for i in range(3000)]
    ledger = spark.createDataFrame(rows, "RegistroANS string, Ano int, Trimestre int, ValorDespesas decimal(15,2)")
    registry = spark.createDataFrame(
        [(str(k), "x", f"op {k}", "M", "SP") for k in range(40)],
        "RegistroANS string, CNPJ string, RazaoSocial string, Modalidade string, UF string")
    out = enriched_ledger(ledger, registry, f"{workdir}/registry")
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r[0]: r[1] for r in out.groupBy("RazaoSocial").count().collect()}
    want = defaultdict(int)
    for k, *_ in rows:
        want[f"op {k}" if int(k) < 40 else f"Operadora {k} Desconhecida"] += 1
    assert got == want


def test_hot_key_is_reduced_before_the_shuffle(spark):
    fact = spark.createDataFrame(make_rows(), SCHEMA)
    plan = windows.first_last(fact, "registro_ans", "data_referencia", "valor_despesa")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text and "SortAggregate" not in text


def test_fact_writer_splits_a_hot_operator(spark, workdir):
    import glob

    import pyarrow.parquet as pq

    from tally.sinks.tables import write_fact

    rows = [(0 if i % 3 == 0 else i % 50, 2023, 1, Decimal(i % 997) / 100) for i in range(6000)]
    fact = spark.createDataFrame(rows, "registro_ans bigint, ano int, trimestre int, "
                                       "valor_despesa decimal(15,2)")
    out = f"{workdir}/fact"
    write_fact(fact, out, partitions=8)
    files = glob.glob(f"{out}/ano=2023/trimestre=1/*.parquet")
    hot_per_file = [sum(1 for k in pq.read_table(f, columns=["registro_ans"]).column(0).to_pylist()
                        if k == 0) for f in files]
    hot = sum(1 for r in rows if r[0] == 0)
    assert sum(hot_per_file) == hot
    assert max(hot_per_file) < hot  # the hot operator is spread over several files/tasks
    assert spark.read.parquet(out).count() == 6000
