"""Plan shape checks and the registered queries against DuckDB on sf0.001."""

import datetime as dt
import decimal
import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["uf", "despesa_total_estado", "media_por_operadora"]
    assert 0 < len(rows) <= 5


def test_every_query_has_an_oracle_or_is_listed(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())


def test_top_states_plan_is_partial_then_final(spark):
    import __spark_entry__ as E

    df = E.queries()["r07_top_states"](spark, SF)
    df.collect()
    p = plan_of(df)
    assert "TakeOrderedAndProject" in p
    assert "partial_sum" in p  # map-side combine before the shuffle


def test_first_last_uses_hash_aggregate(spark):
    import __spark_entry__ as E

    df = E.queries()["r06_growth_top5"](spark, SF)
    df.collect()
    p = plan_of(df)
    assert "SortAggregate" not in p and "Window" not in p


def test_pushdown_and_pruning(spark):
    from tally.sources.tables import expenses_from_testdata

    fact = expenses_from_testdata(spark, SF)
    df = fact.filter("registro_ans = 3").select("valor_despesa")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,3)]" in p
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in p


def scans_of(df, column):
    """Scans of the final plan that read ``column``; a reused exchange shows none."""
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    return sum("FileScan" in line and column in line for line in final.splitlines())


def test_one_scan_where_one_is_enough(spark):
    import __spark_entry__ as E

    queries = E.queries()
    assert scans_of(queries["s02_resolve"](spark, SF), "html") == 1
    assert scans_of(queries["r04_statistics"](spark, SF), "l_suppkey") == 1
    # the keys for the counts, and the rows
    assert scans_of(queries["v04_quarantine"](spark, SF), "o_custkey") <= 2


def test_unused_columns_are_pruned_below_the_period(spark):
    import __spark_entry__ as E

    plan = plan_of(E.queries()["s05_latest_periods"](spark, SF))
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate" in plan and "l_orderkey" not in plan


def test_written_quarters_are_pruned(spark):
    import __spark_entry__ as E

    plan = plan_of(E.queries()["k04_period_folders"](spark, SF))
    assert "(ano#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_tax_id_check_stays_in_jvm(spark):
    import __spark_entry__ as E

    df = E.queries()["v01_cnpj_valid"](spark, SF)
    assert "EvalPython" not in plan_of(df)


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_queries_match_oracle_small(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as E

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for key, sql in E.oracle_sql().items():
        df = E.queries()[key](spark, SF)
        names = df.columns
        a = sorted((tuple(_norm(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
        res = con.sql(sql)
        dn = res.columns
        idx = [dn.index(c) for c in sorted(dn)]
        b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
        if sorted(names) != sorted(dn) or a != b:
            bad.append(key)
    assert bad == []
