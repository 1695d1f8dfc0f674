"""Operator semantics on literal fixtures (FIXTURES.md §3) and properties."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tally.operators import aggregates, joins, ordering, quality, sets, windows
from tally.plans import analytics, mart, serving

D = Decimal
FACT_SCHEMA = "registro_ans bigint, ano int, trimestre int, data_referencia date, valor_despesa decimal(15,2)"
DIM_SCHEMA = "registro_ans bigint, cnpj string, razao_social string, modalidade string, uf string"


def q(y, t):
    return dt.date(y, (t - 1) * 3 + 1, 1)


@pytest.fixture()
def star(spark):
    dim = spark.createDataFrame([
        (1, "11.222.333/0001-81", "Alfa", "M", "SP"),
        (2, "11222333000182", "Beta", "M", "RJ"),
        (3, None, "Gama", "M", None),      # null state: out of state totals
        (4, "00000000000000", "Delta", "M", "SP"),
        (5, "x", "Eps", "M", "MG"),
    ], DIM_SCHEMA)
    rows = [
        # op 1: two rows in the first quarter (D9), growth from 100 -> 150
        (1, 2023, 1, q(2023, 1), D("100.00")), (1, 2023, 1, q(2023, 1), D("300.00")),
        (1, 2023, 2, q(2023, 2), D("150.00")),
        # op 2: one quarter only (growth 0), two rows above the mean in one quarter
        (2, 2023, 2, q(2023, 2), D("900.00")), (2, 2023, 2, q(2023, 2), D("800.00")),
        # op 3: null state
        (3, 2023, 1, q(2023, 1), D("50.00")),
        # op 4: starts at 0 -> guarded out of growth
        (4, 2023, 1, q(2023, 1), D("0.00")), (4, 2023, 2, q(2023, 2), D("10.00")),
        # op 9: orphan (no dimension row)
        (9, 2023, 1, q(2023, 1), D("70.00")),
    ]
    return dim, spark.createDataFrame(rows, FACT_SCHEMA)


def test_first_last_matches_window_form(star):
    _, fact = star
    a = windows.first_last(fact, "registro_ans", "data_referencia", "valor_despesa")
    v = F.col("valor_despesa")
    by = Window.partitionBy("registro_ans")
    b = fact.select(
        "registro_ans",
        F.first_value(v).over(by.orderBy("data_referencia", v)).alias("valor_inicial"),
        F.first_value(v).over(by.orderBy(F.desc("data_referencia"), v)).alias("valor_final")).distinct()
    assert sorted(a.collect()) == sorted(b.collect())
    got = {r[0]: (r[1], r[2]) for r in a.collect()}
    assert got[1] == (D("100.00"), D("150.00"))   # smallest value on the tied first date
    assert got[2] == (D("800.00"), D("800.00"))


def test_growth_guard_and_top(star):
    dim, fact = star
    top = analytics.growth_top(fact, dim, 5).collect()
    by = {r["registro_ans"]: r["crescimento_pct"] for r in top}
    assert by[1] == D("50.00") and by[2] == D("0.00") and 4 not in by
    allg = {r[0]: r[3] for r in analytics.growth_all(fact, "row").collect()}
    assert allg[4] is None  # zero start -> NULL, not a division error


def test_state_totals(star):
    dim, fact = star
    got = {r["uf"]: (r["despesa_total_estado"], r["media_por_operadora"])
           for r in analytics.top_states(fact, dim, 5).collect()}
    assert None not in got
    assert got["SP"] == (D("560.00"), D("280.00"))  # ops 1 and 4
    assert got["RJ"] == (D("1700.00"), D("1700.00"))


def test_above_mean_rows_vs_quarters(star):
    dim, fact = star
    rows = {r[0]: r["qtd_trimestres_acima"] for r in analytics.above_mean(fact, dim, 1, "rows").collect()}
    quarters = {r[0]: r["qtd_trimestres_acima"] for r in analytics.above_mean(fact, dim, 1, "quarters").collect()}
    # Q2 mean = (150 + 900 + 800 + 10) / 4 = 465: op 2 has two rows above in one quarter
    assert rows[2] == 2 and quarters[2] == 1


def test_value_equal_to_mean_is_not_above(spark):
    fact = spark.createDataFrame([(1, 2023, 1, q(2023, 1), D("10.00")),
                                  (2, 2023, 1, q(2023, 1), D("10.00"))], FACT_SCHEMA)
    assert aggregates.above_period_mean(fact).filter("rows_above > 0").count() == 0


def test_keep_first_equals_window_and_partitions(spark):
    rows = [(k % 7, i, f"n{i % 5}", None if i % 11 == 0 else i % 3) for k, i in
            zip(range(200), range(200))]
    df = spark.createDataFrame(rows, "k int, i int, name string, c int")
    order = ["c", "name", "i"]
    a = sets.keep_first(df, ["k"], order)
    w = Window.partitionBy("k").orderBy(F.col("c").asc_nulls_last(), "name", "i")
    b = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())
    c = sets.keep_first(df.repartition(13), ["k"], order)
    assert sorted(a.collect()) == sorted(c.collect())


def test_keep_first_descending(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c")], "k int, v int, s string")
    got = {r[0]: r[2] for r in sets.keep_first(df, ["k"], [("v", False)]).collect()}
    assert got == {1: "b", 2: "c"}


def test_left_enrich_labels_and_row_count(spark):
    ledger = spark.createDataFrame(
        [(" 100004.0 ", D("8.00")), ("100005", D("1.00")), (None, D("7.00"))],
        "RegistroANS string, ValorDespesas decimal(15,2)")
    reg = spark.createDataFrame([("100004", "11222333000181", "Op4", "SP")],
                                "RegistroANS string, CNPJ string, RazaoSocial string, UF string")
    out = joins.left_enrich(ledger, reg).orderBy("ValorDespesas").collect()
    assert len(out) == 3
    by = {r["ValorDespesas"]: r for r in out}
    assert by[D("8.00")]["RazaoSocial"] == "Op4"
    assert by[D("1.00")]["RazaoSocial"] == "Operadora 100005 Desconhecida"
    assert by[D("1.00")]["CNPJ"] == "N/A" and by[D("1.00")]["UF"] == "N/A"
    assert by[D("7.00")]["RazaoSocial"] is None or "Desconhecida" in by[D("7.00")]["RazaoSocial"]


def test_mart_reconciles_with_fact(star, spark):
    dim, fact = star
    ledger = fact.select(F.col("registro_ans").cast("string").alias("RegistroANS"),
                         F.col("ano").alias("Ano"), F.col("trimestre").alias("Trimestre"),
                         F.col("valor_despesa").alias("ValorDespesas"))
    registry = dim.select(F.col("registro_ans").cast("string").alias("RegistroANS"),
                          F.col("cnpj").alias("CNPJ"), F.col("razao_social").alias("RazaoSocial"),
                          F.col("modalidade").alias("Modalidade"), F.col("uf").alias("UF"))
    m = mart.operator_mart(ledger, registry)
    mart_total = m.agg(F.sum("ValorTotal")).first()[0]
    fact_total = fact.join(dim, "registro_ans").agg(F.sum("valor_despesa")).first()[0]
    orphan = quality.referential_audit(fact, dim).first()
    assert orphan["orphan_rows"] == 1 and orphan["orphan_value"] == D("70.00")
    assert mart_total == fact_total + orphan["orphan_value"]  # D23
    rows = {r["RegistroANS"]: r for r in m.collect()}
    assert rows["9"]["RazaoSocial"] == "Operadora 9 Desconhecida"
    assert rows["3"]["DesvioPadrao"] == 0.0  # singleton group -> 0 (A2)
    ordered = [r["ValorTotal"] for r in m.collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_registry_duplicates_do_not_fan_out(spark):
    ledger = spark.createDataFrame([("1", D("5.00"))], "RegistroANS string, ValorDespesas decimal(15,2)")
    registry = spark.createDataFrame(
        [("1", "b", "Second", "M", "SP"), ("1", "a", "First", "M", "SP")],
        "RegistroANS string, CNPJ string, RazaoSocial string, Modalidade string, UF string")
    m = mart.operator_mart(ledger, registry).collect()
    assert len(m) == 1 and m[0]["RazaoSocial"] == "First" and m[0]["QtdRegistros"] == 1


def test_pages_tile_listing(star):
    dim, _ = star
    all_rows = [r[0] for r in ordering.ranked(dim, ["registro_ans"]).collect()]
    pages = []
    for p in range(1, 4):
        pages += [r[0] for r in serving.listing_rows(dim, None, p, 2).collect()]
    assert pages == all_rows
    with pytest.raises(ValueError):
        serving.listing_rows(dim, None, 0, 10)


def test_keyset_pages_equal_offset_pages(star, spark, workdir):
    dim, _ = star
    after, pages = None, []
    for _ in range(3):
        rows = [r["registro_ans"] for r in serving.listing_rows_after(dim, None, after, 2).collect()]
        pages.append(rows)
        after = rows[-1] if rows else after
    offset = [[r["registro_ans"] for r in serving.listing_rows(dim, None, p, 2).collect()]
              for p in (1, 2, 3)]
    assert pages == offset
    dim.write.parquet(f"{workdir}/dim")
    stored = spark.read.parquet(f"{workdir}/dim")
    plan = ordering.page_after(stored, "registro_ans", 2, 2)._jdf.queryExecution().executedPlan()
    assert "GreaterThan(registro_ans,2)" in plan.toString()  # reaches the parquet scan


def test_listing_envelope_and_search(star):
    dim, _ = star
    env = serving.listing(dim, "alf", 1, 10).first()
    assert env["total"] == 1 and env["page"] == 1 and env["limit"] == 10
    assert [d["razao_social"] for d in env["data"]] == ["Alfa"]
    # '%' is a wildcard unless literal
    assert serving.listing_total(dim, "%").first()[0] == 5
    assert serving.listing_total(dim, "%", literal=True).first()[0] == 0


def test_detail_and_history(star):
    dim, fact = star
    assert serving.operator_detail(dim, "abc").count() == 0  # D15: no digits -> no rows
    det = serving.operator_detail(dim, "11222333000181").collect()
    assert [r["registro_ans"] for r in det] == [1]
    hist = serving.expense_history(fact, dim, "11.222.333/0001-81").collect()
    assert [r["data_referencia"] for r in hist] == ["2023-04-01", "2023-01-01", "2023-01-01"]
    assert isinstance(hist[0]["valor_despesa"], float)


def test_statistics_envelope(star):
    dim, fact = star
    st = serving.statistics(fact, dim).first()
    assert st["total_despesas"] == 2380.0
    assert [x["nome"] for x in st["top_5_operadoras"]][:2] == ["Beta", "Alfa"]
    assert [x["nome"] for x in st["top_estados"]] == ["RJ", "SP"]
    ch = serving.chart_series(fact, dim).first()
    assert ch["labels"] == ["RJ", "SP"] and ch["values"] == [1700.0, 560.0]


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    clean, bad = quality.quarantine(df, ["k"])
    assert sorted(r["v"] for r in clean.collect()) == ["c"]
    assert sorted((r["v"], r["reason"]) for r in bad.collect()) == [
        ("a", "duplicate_key"), ("b", "duplicate_key"), ("d", "null_key")]


def test_domain_violations(spark):
    df = spark.createDataFrame([("SPX", "1.00"), ("SP", "99999999999999999.00")],
                               "uf string, v string")
    bad = quality.domain_violations(df, {"uf": 2}, {"v": (15, 2)}).collect()
    assert len(bad) == 2 and bad[0]["uf_too_long"] is True


def test_cnpj_audit(star):
    dim, fact = star
    named = fact.join(dim.select("registro_ans", "cnpj"), "registro_ans")
    got = {r["registro_ans"] for r in quality.cnpj_audit(named).collect()}
    assert got == {2, 3, 4}  # wrong digit, null, all equal digits (op 5 has no rows)


def test_union_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "k int, conta string")
    b = spark.createDataFrame([(2,)], "k int")
    u = sets.union_all([a, b]).orderBy("k").collect()
    assert [tuple(r) for r in u] == [(1, "x"), (2, None)]
    assert sets.distinct_rows(sets.union_all([a, a]), ["k"]).count() == 1


def test_profile_and_means(star):
    _, fact = star
    prof = {r[0]: r for r in aggregates.operator_profile(fact, ["registro_ans"], "valor_despesa",
                                                          ).collect()}
    assert prof[3]["DesvioPadrao"] == 0.0 and prof[1]["QtdRegistros"] == 3
    assert aggregates.global_total(fact.limit(0)).first()[0] == 0
    assert aggregates.mean_of_totals(fact.limit(0)).first()[0] == 0


def test_service_surface(star, spark):
    from tally.plans.service import LedgerService, register_views

    dim, fact = star
    svc = LedgerService(dim, fact)
    page = svc.operators(1, 2, None)
    assert page["total"] == 5 and [d["registro_ans"] for d in page["data"]] == [1, 2]
    assert svc.operator("no digits") is None
    assert svc.operator("11.222.333/0001-81")["razao_social"] == "Alfa"
    assert len(svc.history_page("11222333000181", 1, 2)) == 2
    assert svc.history("11222333000181").count() == 3
    st = svc.statistics()
    assert st["top_estados"][0] == {"nome": "RJ", "total": 1700.0}
    assert svc.chart()["labels"] == ["RJ", "SP"]
    names = register_views(spark, dim, fact)
    got = spark.sql(f"SELECT o.uf, SUM(d.valor_despesa) AS t FROM {names['fact']} d "
                    f"JOIN {names['dimension']} o ON d.registro_ans = o.registro_ans "
                    f"WHERE o.uf IS NOT NULL GROUP BY o.uf ORDER BY t DESC LIMIT 1").first()
    assert got["uf"] == "RJ"


def test_positional_mart_load(spark):
    from tally.plans.warehouse import load_mart

    staging = spark.createDataFrame(
        [("100.001", "11.222.333/0001-81", "Alfa", "SP ", "1234,565", "10,00", "0,5", "3")],
        "a string, b string, c string, d string, e string, f string, g string, h string")
    r = load_mart(staging).first()
    assert r["registro_ans"] == 100001 and r["uf"] == "SP"
    assert r["valor_total"] == D("1234.57") and r["desvio_padrao"] == D("0.50")
    assert "qtd_registros" not in load_mart(staging).columns  # the load drops the count


def test_broadcast_only_behind_measured_size(spark):
    small = spark.createDataFrame([(i, "x" * 10) for i in range(50)], "k int, s string")
    big_rows = spark.range(0, 2000).withColumnRenamed("id", "k")
    assert joins.fits(small, 100, 10_000)
    assert not joins.fits(small, 10, 10_000)          # too many rows
    assert not joins.fits(small, 100, 500)            # too many bytes
    fact = spark.range(0, 100).withColumnRenamed("id", "k")
    hinted = joins.join_dimension(fact, small, "k", max_rows=100)
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert joins.maybe_broadcast(big_rows, 100) is big_rows   # no hint beyond the bound


def test_keep_rows_matches_filter_and_computes_once(spark):
    from tally.operators.filters import keep_rows

    df = spark.createDataFrame([("a1",), ("b",), (None,), ("c22",)], "t string")
    derived = df.withColumn("d", F.regexp_extract("t", r"(\d+)", 1))
    a = keep_rows(derived, lambda r: r["d"] != "")
    b = derived.filter(F.col("d") != "")
    assert sorted(a.collect()) == sorted(b.collect()) and a.columns == derived.columns
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1


def test_history_page_bounds(star):
    from tally.plans.service import LedgerService

    dim, fact = star
    svc = LedgerService(dim, fact)
    first = svc.history_page("11222333000181", 1, 2)
    second = svc.history_page("11222333000181", 2, 2)
    assert len(first) == 2 and len(second) == 1
    assert [r["data_referencia"] for r in first + second] == ["2023-04-01", "2023-01-01", "2023-01-01"]
    with pytest.raises(ValueError):
        svc.history_page("11222333000181", 0, 2)


def test_left_enrich_null_safe(spark):
    ledger = spark.createDataFrame([(None, D("7.00")), ("5", D("1.00"))],
                                   "RegistroANS string, ValorDespesas decimal(15,2)")
    reg = spark.createDataFrame([(None, "x", "NullKeyOp", "SP"), ("5", "y", "Five", "RJ")],
                                "RegistroANS string, CNPJ string, RazaoSocial string, UF string")
    plain = {r["ValorDespesas"]: r["RazaoSocial"] for r in joins.left_enrich(ledger, reg).collect()}
    safe = {r["ValorDespesas"]: r["RazaoSocial"]
            for r in joins.left_enrich(ledger, reg, null_safe=True).collect()}
    assert plain[D("1.00")] == "Five" and plain[D("7.00")] is None   # NULL never matches (D4)
    assert safe[D("7.00")] == "NullKeyOp"                              # opt-in NULL = NULL
