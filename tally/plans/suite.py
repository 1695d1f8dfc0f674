"""Registered queries over the driver tables, and their DuckDB oracle SQL.

Every query reads the whole driver tables (mapped onto the ledger model by
``tally.sources.tables``) and returns a DataFrame whose column names and
value types line up with the oracle statement of the same key:

* money is summed/compared as exact decimals and converted to DOUBLE only at
  the edge (``edge``), on both sides;
* rounded quotients are computed exactly: decimal ``round`` (HALF_UP) here,
  integer cents arithmetic in the oracle;
* counts are BIGINT on both sides.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from ..functions.taxid import WEIGHTS_1, WEIGHTS_2
from ..plans import analytics
from ..session import scratch_path
from ..sources.tables import expenses_from_testdata, operators_from_testdata

SHEET_ROWS = 250_000  # rows of a workbook, about
ARCHIVE_ROWS = 250_000  # rows of a quarter in one archive, about

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def edge(df: DataFrame) -> DataFrame:
    """Decimals -> DOUBLE at the result edge (after all exact arithmetic)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def scratch_folder(spark: SparkSession, key: str) -> str:
    """A new folder for the tables that one run of a query writes (shared checkpoint folder)."""
    return scratch_path(spark, f"suite/{key}-{uuid.uuid4().hex}")


def dim_fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return operators_from_testdata(spark, sf_dir), expenses_from_testdata(spark, sf_dir)


# --------------------------------------------------------------------------
# Oracle building blocks (DuckDB SQL text).
# --------------------------------------------------------------------------

def _sql_check(base: str, weights) -> str:
    total = " + ".join(
        f"CAST(substr({base}, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights)
    )
    return f"((11 - (({total}) % 11)) % 11 % 10)"


def sql_cnpj_valid(col: str) -> str:
    """Oracle form of the tax-id check, written out term by term."""
    d = f"regexp_replace(coalesce({col}, ''), '[^0-9]', '', 'g')"
    c1 = _sql_check(d, WEIGHTS_1)
    c2 = _sql_check(d, WEIGHTS_2)
    return (
        f"(CASE WHEN length({d}) = 14 AND NOT regexp_full_match({d}, '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+') "
        f"THEN ({c1} = CAST(substr({d}, 13, 1) AS INTEGER) AND {c2} = CAST(substr({d}, 14, 1) AS INTEGER)) "
        f"ELSE false END)"
    )


_D1 = _sql_check("b", WEIGHTS_1)
_D2 = _sql_check("(b || CAST(d1 AS VARCHAR))", WEIGHTS_2)

BASE_CTES = f"""
sup_b AS (
  SELECT s.*, lpad(CAST(s.s_suppkey AS VARCHAR), 12, '0') AS b FROM supplier s),
sup_d1 AS (SELECT *, {_D1} AS d1 FROM sup_b),
sup_d2 AS (
  SELECT *, ({_D2} + (s_suppkey + s_nationkey) % 2) % 10 AS d2
  FROM sup_d1),
sup_c AS (SELECT *, b || CAST(d1 AS VARCHAR) || CAST(d2 AS VARCHAR) AS c14 FROM sup_d2),
operadoras AS (
  SELECT s.s_suppkey AS registro_ans,
         substr(c14, 1, 2) || '.' || substr(c14, 3, 3) || '.' || substr(c14, 6, 3) || '/'
           || substr(c14, 9, 4) || '-' || substr(c14, 13, 2) AS cnpj,
         s.s_name AS razao_social,
         r.r_name AS modalidade,
         lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS uf
  FROM sup_c s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
despesas AS (
  SELECT l_suppkey AS registro_ans,
         CAST(year(l_shipdate) AS INTEGER) AS ano,
         CAST(quarter(l_shipdate) AS INTEGER) AS trimestre,
         make_date(CAST(year(l_shipdate) AS INTEGER), (CAST(quarter(l_shipdate) AS INTEGER) - 1) * 3 + 1, 1)
           AS data_referencia,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS valor_despesa
  FROM lineitem)
"""


def with_base(body: str) -> str:
    return f"WITH {BASE_CTES.strip()},\n{body.strip()}"


def sql_round_div(num_cents: str, den: str, scale_pow: int = 1) -> str:
    """Exact HALF_UP round of ``num/den`` to 2 decimals, as DOUBLE.

    ``num_cents`` is an integer count of cents, ``den`` a positive integer.
    """
    n = f"CAST({num_cents} AS HUGEINT) * {scale_pow}"
    return (
        f"(CASE WHEN {n} >= 0 THEN (2 * {n} + {den}) // (2 * {den}) "
        f"ELSE -((-2 * {n} + {den}) // (2 * {den})) END) / 100.0"
    )


# --------------------------------------------------------------------------
# R7 (flagship): top 5 states by expense, with mean per operator.
# --------------------------------------------------------------------------

@register("r07_top_states", with_base(f"""
by_state AS (
  SELECT o.uf, SUM(d.valor_despesa) AS s, COUNT(DISTINCT d.registro_ans) AS n
  FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
  WHERE o.uf IS NOT NULL
  GROUP BY o.uf)
SELECT uf,
       CAST(s AS DOUBLE) AS despesa_total_estado,
       {sql_round_div("s * 100", "n")} AS media_por_operadora
FROM by_state
ORDER BY despesa_total_estado DESC, uf
LIMIT 5
"""))
def r07_top_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, fact = dim_fact(spark, sf_dir)
    return edge(analytics.top_states(fact, dim, 5))


# --------------------------------------------------------------------------
# Shared derived inputs (Spark side) and their oracle CTEs.
# --------------------------------------------------------------------------

RAW_LEDGER_SQL = """
raw_ledger AS (
  SELECT l_orderkey, l_linenumber,
         CAST(l_suppkey AS VARCHAR) AS REG_ANS,
         CAST(l_partkey AS VARCHAR) AS CD_CONTA_CONTABIL,
         CASE
           WHEN l_linenumber = 1 THEN translate(format('{:,.2f}', CAST(l_extendedprice AS DECIMAL(15,2))), ',.', '.,')
           WHEN l_linenumber = 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)
           WHEN l_linenumber = 3 THEN CAST(floor(CAST(l_extendedprice AS DECIMAL(15,2))) AS VARCHAR) || 'd'
           WHEN l_linenumber = 4 THEN ''
           WHEN l_linenumber = 5 THEN '-' || replace(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), '.', ',')
           ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), '.', ',')
         END AS VL_SALDO_FINAL,
         CAST(year(l_shipdate) AS INTEGER) AS ano,
         CAST(quarter(l_shipdate) AS INTEGER) AS trimestre
  FROM lineitem)
"""

NUMERIC_SQL = r"'\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*'"


def sql_parse_number(text: str, locale: str = "br") -> str:
    norm = f"translate({text}, ',.', '.')" if locale == "br" else text
    return (f"CASE WHEN regexp_full_match({norm}, {NUMERIC_SQL}) "
            f"THEN TRY_CAST(trim({norm}) AS DECIMAL(15,2)) ELSE CAST(0 AS DECIMAL(15,2)) END")


CONSOLIDATED_SQL = f"""
consolidated AS (
  SELECT REG_ANS AS RegistroANS, 'N/A' AS CNPJ, 'N/A' AS RazaoSocial,
         ano AS Ano, trimestre AS Trimestre, v AS ValorDespesas
  FROM (SELECT *, {sql_parse_number('VL_SALDO_FINAL')} AS v FROM raw_ledger
        WHERE starts_with(CD_CONTA_CONTABIL, '4'))
  WHERE v > 0)
"""

REGISTRY_SQL = """
registry AS (
  SELECT CAST(registro_ans AS VARCHAR) AS RegistroANS, cnpj AS CNPJ, razao_social AS RazaoSocial,
         modalidade AS Modalidade, uf AS UF
  FROM operadoras)
"""


def with_ctes(*ctes: str, body: str) -> str:
    parts = [BASE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import raw_ledger_from_testdata

    return raw_ledger_from_testdata(spark, sf_dir)


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.consolidate import canonical_ledger, consolidate

    raw = raw_ledger(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    return consolidate([canonical_ledger(raw, period_cols=("ano", "trimestre"))])


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = operators_from_testdata(spark, sf_dir)
    return dim.select(
        F.col("registro_ans").cast("string").alias("RegistroANS"),
        F.col("cnpj").alias("CNPJ"), F.col("razao_social").alias("RazaoSocial"),
        F.col("modalidade").alias("Modalidade"), F.col("uf").alias("UF"),
    )


def sql_half_up_ratio(num: str, den: str, factor: int = 100) -> str:
    """Oracle: exact HALF_UP of ``num/den`` to 2 decimals as DOUBLE, for
    integer ``num`` (already scaled to cents-like units) and positive ``den``."""
    n = f"(CAST({num} AS HUGEINT) * {factor})"
    d = f"CAST({den} AS HUGEINT)"
    return (f"((CASE WHEN {n} >= 0 THEN (2 * {n} + {d}) // (2 * {d}) "
            f"ELSE -((-2 * {n} + {d}) // (2 * {d})) END) / 100.0)")


# --------------------------------------------------------------------------
# Growth from first to last period.
# --------------------------------------------------------------------------

_GROWTH_BODY = """
SELECT e.registro_ans, o.razao_social,
       CAST(e.vi AS DOUBLE) AS valor_inicial,
       CAST(e.vf AS DOUBLE) AS valor_final,
       {growth} AS crescimento_pct
FROM ends e JOIN operadoras o ON e.registro_ans = o.registro_ans
WHERE e.vi > 0
ORDER BY crescimento_pct DESC NULLS LAST, e.registro_ans
LIMIT 5
"""
_GROWTH = sql_half_up_ratio("(e.vf - e.vi) * 100", "e.vi * 100", 10000)


@register("r06_growth_top5", with_ctes("""
lim AS (
  SELECT registro_ans,
         first_value(valor_despesa) OVER (PARTITION BY registro_ans ORDER BY data_referencia, valor_despesa) AS vi,
         first_value(valor_despesa) OVER (PARTITION BY registro_ans ORDER BY data_referencia DESC, valor_despesa) AS vf
  FROM despesas)""", """
ends AS (SELECT DISTINCT registro_ans, vi, vf FROM lim)""", body=_GROWTH_BODY.format(growth=_GROWTH)))
def r06_growth_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, fact = dim_fact(spark, sf_dir)
    return edge(analytics.growth_top(fact, dim, 5, grain="row"))


@register("r06_growth_quarter_grain", with_ctes("""
q AS (SELECT registro_ans, data_referencia, SUM(valor_despesa) AS v FROM despesas
      GROUP BY registro_ans, data_referencia)""", """
ends AS (SELECT registro_ans, arg_min(v, data_referencia) AS vi, arg_max(v, data_referencia) AS vf
         FROM q GROUP BY registro_ans)""", body=_GROWTH_BODY.format(growth=_GROWTH)))
def r06_growth_quarter_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, fact = dim_fact(spark, sf_dir)
    return edge(analytics.growth_top(fact, dim, 5, grain="quarter"))


@register("c09_growth_guard", with_ctes("""
q AS (SELECT registro_ans, data_referencia, SUM(valor_despesa) AS v FROM despesas
      GROUP BY registro_ans, data_referencia)""", """
e AS (SELECT registro_ans, arg_min(v, data_referencia) AS vi, arg_max(v, data_referencia) AS vf
      FROM q GROUP BY registro_ans)""", body=f"""
SELECT registro_ans, CAST(vi AS DOUBLE) AS valor_inicial, CAST(vf AS DOUBLE) AS valor_final,
       CASE WHEN vi = 0 THEN NULL ELSE {_GROWTH} END AS crescimento_pct
FROM e
"""))
def c09_growth_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = expenses_from_testdata(spark, sf_dir)
    return edge(analytics.growth_all(fact, grain="quarter"))


# --------------------------------------------------------------------------
# Operators above the period mean at least twice.
# --------------------------------------------------------------------------

_ABOVE = """
m AS (SELECT ano, trimestre, SUM(valor_despesa) AS s, COUNT(*) AS n FROM despesas GROUP BY ano, trimestre),
p AS (SELECT d.registro_ans, d.ano, d.trimestre,
             CASE WHEN d.valor_despesa * m.n > m.s THEN 1 ELSE 0 END AS acima
      FROM despesas d JOIN m ON d.ano = m.ano AND d.trimestre = m.trimestre)
"""


@register("r08_above_mean_rows", with_ctes(_ABOVE, body="""
SELECT p.registro_ans, o.razao_social, CAST(SUM(p.acima) AS BIGINT) AS qtd_trimestres_acima
FROM p JOIN operadoras o ON p.registro_ans = o.registro_ans
GROUP BY p.registro_ans, o.razao_social
HAVING SUM(p.acima) >= 2
"""))
def r08_above_mean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, fact = dim_fact(spark, sf_dir)
    return analytics.above_mean(fact, dim, 2, count="rows")


@register("r08_above_mean_quarters", with_ctes(_ABOVE, body="""
SELECT p.registro_ans, o.razao_social,
       COUNT(DISTINCT CASE WHEN p.acima = 1 THEN p.ano * 10 + p.trimestre END) AS qtd_trimestres_acima
FROM p JOIN operadoras o ON p.registro_ans = o.registro_ans
GROUP BY p.registro_ans, o.razao_social
HAVING COUNT(DISTINCT CASE WHEN p.acima = 1 THEN p.ano * 10 + p.trimestre END) >= 2
"""))
def r08_above_mean_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, fact = dim_fact(spark, sf_dir)
    return analytics.above_mean(fact, dim, 2, count="quarters")


# --------------------------------------------------------------------------
# Aggregations (A1-A10) and the served KPIs.
# --------------------------------------------------------------------------

@register("a01_operator_profile", with_ctes(body=f"""
SELECT d.registro_ans, o.cnpj, o.razao_social, o.uf,
       CAST(SUM(d.valor_despesa) AS DOUBLE) AS valor_total,
       {sql_half_up_ratio("SUM(d.valor_despesa) * 100", "COUNT(*)", 1)} AS media,
       round(coalesce(stddev_samp(d.valor_despesa), 0), 4) AS desvio_padrao,
       COUNT(*) AS qtd_registros
FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
GROUP BY d.registro_ans, o.cnpj, o.razao_social, o.uf
"""))
def a01_operator_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.aggregates import operator_profile

    dim, fact = dim_fact(spark, sf_dir)
    prof = operator_profile(fact, ["registro_ans"], "valor_despesa",
                            names=("valor_total", "_avg", "_std", "qtd_registros"))
    named = prof.join(dim.select("registro_ans", "cnpj", "razao_social", "uf"), "registro_ans")
    return edge(named.select(
        "registro_ans", "cnpj", "razao_social", "uf", "valor_total",
        F.round(F.col("valor_total") / F.col("qtd_registros").cast("decimal(20,0)"), 2).alias("media"),
        F.round("_std", 4).alias("desvio_padrao"), "qtd_registros",
    ))


@register("a02_singleton_std", """
SELECT o_custkey, COUNT(o_totalprice) AS qtd,
       round(coalesce(stddev_samp(o_totalprice), 0), 4) AS desvio_padrao
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
""")
def a02_singleton_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.aggregates import operator_profile
    from ..sources.tables import read_table

    profile = operator_profile(read_table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice")
    return profile.select("o_custkey", F.col("QtdRegistros").alias("qtd"),
                          F.round("DesvioPadrao", 4).alias("desvio_padrao"))


@register("a05_period_mean", with_ctes(body=f"""
SELECT ano, trimestre, CAST(SUM(valor_despesa) AS DOUBLE) AS period_sum, COUNT(*) AS period_rows,
       {sql_half_up_ratio("SUM(valor_despesa) * 100", "COUNT(*)", 1)} AS media_geral
FROM despesas GROUP BY ano, trimestre
"""))
def a05_period_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.aggregates import period_mean

    fact = expenses_from_testdata(spark, sf_dir)
    return edge(period_mean(fact))


@register("a07_global_total", with_ctes(body="""
SELECT CAST(coalesce(SUM(valor_despesa), 0) AS DOUBLE) AS total_despesas FROM despesas
"""))
def a07_global_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.aggregates import global_total

    fact = expenses_from_testdata(spark, sf_dir)
    return edge(global_total(fact))


@register("a08_mean_of_totals", with_ctes(body=f"""
t AS (SELECT registro_ans, SUM(valor_despesa) AS total FROM despesas GROUP BY registro_ans)
SELECT coalesce({sql_half_up_ratio("SUM(total) * 100", "COUNT(*)", 1)}, 0) AS media_por_operadora FROM t
""").replace("\nt AS", ",\nt AS", 1))
def a08_mean_of_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.aggregates import mean_of_totals

    fact = expenses_from_testdata(spark, sf_dir)
    return edge(mean_of_totals(fact))


@register("a10_top_operators", with_ctes(body="""
SELECT o.registro_ans, o.razao_social, CAST(SUM(d.valor_despesa) AS DOUBLE) AS total
FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
GROUP BY o.registro_ans, o.razao_social
ORDER BY SUM(d.valor_despesa) DESC, o.registro_ans
LIMIT 5
"""))
def a10_top_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import top_operators

    dim, fact = dim_fact(spark, sf_dir)
    return edge(top_operators(fact, dim, 5))


@register("a03_top_states", with_ctes(body="""
SELECT o.uf, CAST(SUM(d.valor_despesa) AS DOUBLE) AS total
FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
WHERE o.uf IS NOT NULL
GROUP BY o.uf
ORDER BY SUM(d.valor_despesa) DESC, o.uf
LIMIT 10
"""))
def a03_top_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import top_state_totals

    dim, fact = dim_fact(spark, sf_dir)
    return edge(top_state_totals(fact, dim, 10))


@register("r05_chart_series", with_ctes(body="""
t AS (SELECT o.uf, SUM(d.valor_despesa) AS total
      FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
      WHERE o.uf IS NOT NULL GROUP BY o.uf ORDER BY total DESC, o.uf LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY total DESC, uf) - 1 AS INTEGER) AS pos,
       uf AS label, CAST(total AS DOUBLE) AS value
FROM t
""").replace("\nt AS", ",\nt AS", 1))
def r05_chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import chart_series

    dim, fact = dim_fact(spark, sf_dir)
    series = chart_series(fact, dim, 10)
    return series.select(F.posexplode(F.arrays_zip("labels", "values")).alias("pos", "z")).select(
        "pos", F.col("z.labels").alias("label"), F.col("z.values").alias("value")
    )


# --------------------------------------------------------------------------
# Served listing / detail / history (R1-R3: F4, A9, T3, F5, T4, C11).
# --------------------------------------------------------------------------

SEARCH_TERM = "0001"
DETAIL_KEY = 4


def detail_argument(spark: SparkSession, sf_dir: str, key: int = DETAIL_KEY) -> str:
    """The tax id, as stored, of operator ``key`` (a one-row lookup): the
    argument a user would type to open that operator."""
    dim = operators_from_testdata(spark, sf_dir)
    rows = dim.filter(F.col("registro_ans") == key).select("cnpj").limit(1).collect()
    return rows[0][0] if rows else ""


DETAIL_ARG_SQL = f"(SELECT cnpj FROM operadoras WHERE registro_ans = {DETAIL_KEY} LIMIT 1)"


@register("t03_listing_page", with_ctes(body=f"""
SELECT registro_ans, cnpj, razao_social, uf FROM operadoras
WHERE razao_social ILIKE '%{SEARCH_TERM}%' OR cnpj ILIKE '%{SEARCH_TERM}%'
ORDER BY registro_ans LIMIT 10 OFFSET 10
"""))
def t03_listing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import listing_rows

    dim = operators_from_testdata(spark, sf_dir)
    return listing_rows(dim, SEARCH_TERM, page_no=2, limit=10)


@register("a09_listing_total", with_ctes(body=f"""
SELECT COUNT(*) AS total FROM operadoras
WHERE razao_social ILIKE '%{SEARCH_TERM}%' OR cnpj ILIKE '%{SEARCH_TERM}%'
"""))
def a09_listing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import listing_total

    return listing_total(operators_from_testdata(spark, sf_dir), SEARCH_TERM)


@register("r02_detail", with_ctes(body=f"""
SELECT registro_ans, cnpj, razao_social, uf, modalidade FROM operadoras
WHERE regexp_replace(cnpj, '[^0-9]', '', 'g') = regexp_replace({DETAIL_ARG_SQL}, '[^0-9]', '', 'g')
ORDER BY registro_ans LIMIT 1
"""))
def r02_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import operator_detail

    return operator_detail(operators_from_testdata(spark, sf_dir), detail_argument(spark, sf_dir))


@register("r03_history", with_ctes(body=f"""
SELECT d.ano, d.trimestre, strftime(d.data_referencia, '%Y-%m-%d') AS data_referencia,
       CAST(d.valor_despesa AS DOUBLE) AS valor_despesa
FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
WHERE regexp_replace(o.cnpj, '[^0-9]', '', 'g') = regexp_replace({DETAIL_ARG_SQL}, '[^0-9]', '', 'g')
ORDER BY d.data_referencia DESC, d.valor_despesa DESC
"""))
def r03_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import expense_history

    dim, fact = dim_fact(spark, sf_dir)
    return expense_history(fact, dim, detail_argument(spark, sf_dir))


# --------------------------------------------------------------------------
# Pipelines: consolidation (R9), enrichment + mart (R10), warehouse fact.
# --------------------------------------------------------------------------

@register("r09_consolidate", with_ctes(RAW_LEDGER_SQL, CONSOLIDATED_SQL, body="""
SELECT RegistroANS, CNPJ, RazaoSocial, Ano, Trimestre, CAST(ValorDespesas AS DOUBLE) AS ValorDespesas
FROM consolidated
"""))
def r09_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(consolidated(spark, sf_dir))


_MART_SQL = f"""
SELECT c.RegistroANS,
       coalesce(r.CNPJ, 'N/A') AS CNPJ,
       coalesce(r.RazaoSocial, 'Operadora ' || c.RegistroANS || ' Desconhecida') AS RazaoSocial,
       coalesce(r.UF, 'N/A') AS UF,
       CAST(SUM(c.ValorDespesas) AS DOUBLE) AS ValorTotal,
       {sql_half_up_ratio("SUM(c.ValorDespesas) * 100", "COUNT(*)", 1)} AS MediaTrimestral,
       round(coalesce(stddev_samp(c.ValorDespesas), 0), 2) AS DesvioPadrao,
       COUNT(c.ValorDespesas) AS QtdRegistros
FROM consolidated c LEFT JOIN registry r ON c.RegistroANS = r.RegistroANS
WHERE c.RegistroANS IS NOT NULL
GROUP BY 1, 2, 3, 4
"""


@register("r10_mart", with_ctes(RAW_LEDGER_SQL, CONSOLIDATED_SQL, REGISTRY_SQL, body=_MART_SQL))
def r10_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.mart import operator_mart

    return edge(operator_mart(consolidated(spark, sf_dir), registry(spark, sf_dir)))


@register("r11_fact", with_ctes(RAW_LEDGER_SQL, CONSOLIDATED_SQL, body="""
SELECT CAST(c.RegistroANS AS BIGINT) AS registro_ans, c.Ano AS ano, c.Trimestre AS trimestre,
       make_date(c.Ano, (c.Trimestre - 1) * 3 + 1, 1) AS data_referencia,
       CAST(c.ValorDespesas AS DOUBLE) AS valor_despesa
FROM consolidated c JOIN operadoras o ON CAST(c.RegistroANS AS BIGINT) = o.registro_ans
"""))
def r11_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.warehouse import load_dimension, load_fact

    staging = consolidated(spark, sf_dir).withColumn(
        "ValorDespesas", F.replace(F.col("ValorDespesas").cast("string"), F.lit("."), F.lit(","))
    )
    dim, _ = load_dimension(registry(spark, sf_dir))
    return edge(load_fact(staging, dim, check_size=False))


@register("j01_left_enrich", with_ctes(RAW_LEDGER_SQL, CONSOLIDATED_SQL, REGISTRY_SQL, body=f"""
SELECT c.RegistroANS, c.Ano, c.Trimestre, CAST(c.ValorDespesas AS DOUBLE) AS ValorDespesas,
       coalesce(r.CNPJ, 'N/A') AS CNPJ,
       coalesce(r.RazaoSocial, 'Operadora ' || c.RegistroANS || ' Desconhecida') AS RazaoSocial,
       coalesce(r.UF, 'N/A') AS UF, r.Modalidade,
       {sql_cnpj_valid("coalesce(r.CNPJ, 'N/A')")} AS CNPJ_Valido
FROM consolidated c LEFT JOIN registry r ON c.RegistroANS = r.RegistroANS
"""))
def j01_left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.mart import enriched_ledger

    led = consolidated(spark, sf_dir)
    stored = scratch_folder(spark, "j01")
    return edge(enriched_ledger(led, registry(spark, sf_dir), stored).select(
        "RegistroANS", "Ano", "Trimestre", "ValorDespesas", "CNPJ", "RazaoSocial", "UF",
        "Modalidade", "CNPJ_Valido"))


@register("j02_key_clean", r"""
SELECT l_orderkey, l_linenumber, k AS raw_key,
       regexp_replace(regexp_replace(k, '^\s+|\s+$', '', 'g'), '\.0$', '') AS clean_key
FROM (SELECT l_orderkey, l_linenumber,
             CASE l_returnflag WHEN 'A' THEN ' ' || CAST(l_suppkey AS VARCHAR) || '.0 '
                               WHEN 'R' THEN CAST(l_suppkey AS VARCHAR) || '.0'
                               ELSE chr(9) || CAST(l_suppkey AS VARCHAR) END AS k
      FROM lineitem)
""")
def j02_key_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import clean_key
    from ..sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem")
    key = F.col("l_suppkey").cast("string")
    raw = (F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), key, F.lit(".0 ")))
           .when(F.col("l_returnflag") == "R", F.concat(key, F.lit(".0")))
           .otherwise(F.concat(F.lit("\t"), key)))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw_key")).withColumn(
        "clean_key", clean_key(F.col("raw_key")))


@register("v03_orphans", with_ctes(body="""
SELECT COUNT(*) AS orphan_rows, CAST(coalesce(SUM(valor_despesa), 0) AS DOUBLE) AS orphan_value
FROM despesas d WHERE NOT EXISTS (SELECT 1 FROM operadoras o WHERE o.registro_ans = d.registro_ans)
"""))
def v03_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import referential_audit

    dim, fact = dim_fact(spark, sf_dir)
    return edge(referential_audit(fact, dim))


@register("v01_cnpj_valid", with_ctes(body=f"""
SELECT registro_ans, cnpj, {sql_cnpj_valid('cnpj')} AS cnpj_valido FROM operadoras
"""))
def v01_cnpj_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.taxid import cnpj_is_valid

    dim = operators_from_testdata(spark, sf_dir)
    return dim.select("registro_ans", "cnpj", cnpj_is_valid("cnpj").alias("cnpj_valido"))


@register("v02_cnpj_audit", with_ctes(body=f"""
SELECT o.cnpj, d.registro_ans, COUNT(*) AS qtd_registros,
       CAST(SUM(d.valor_despesa) AS DOUBLE) AS valor_total
FROM despesas d JOIN operadoras o ON d.registro_ans = o.registro_ans
GROUP BY o.cnpj, d.registro_ans
HAVING NOT {sql_cnpj_valid('o.cnpj')}
"""))
def v02_cnpj_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import cnpj_audit

    dim, fact = dim_fact(spark, sf_dir)
    per_op = fact.groupBy("registro_ans").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("valor_despesa").alias("_v"))
    named = per_op.join(dim.select("registro_ans", "cnpj"), "registro_ans")
    # per-operator partials are re-summed per tax id: exact, and the check
    # runs once per operator
    return edge(cnpj_audit(named, "cnpj", "registro_ans", "_v", rows="_n").select(
        "cnpj", "registro_ans", "qtd_registros", "valor_total"))


@register("v04_quarantine", """
SELECT reason, COUNT(*) AS n_rows
FROM (SELECT CASE WHEN o_custkey IS NULL THEN 'null_key'
                  WHEN COUNT(*) OVER (PARTITION BY o_custkey) > 1 THEN 'duplicate_key'
                  ELSE 'clean' END AS reason
      FROM orders)
GROUP BY reason
""")
def v04_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import with_reason
    from ..sources.tables import read_table

    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    marked = with_reason(orders, ["o_custkey"])
    return marked.groupBy(F.coalesce("reason", F.lit("clean")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------
# Sets (X1-X3) and filters (F1, F2).
# --------------------------------------------------------------------------

@register("x01_union", """
SELECT 'lineitem' AS source, l_suppkey AS registro, CAST(l_partkey AS VARCHAR) AS conta,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS valor
FROM lineitem
UNION ALL
SELECT 'orders' AS source, o_custkey AS registro, NULL AS conta,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS valor
FROM orders
""")
def x01_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.sets import union_all
    from ..sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem").select(
        F.lit("lineitem").alias("source"), F.col("l_suppkey").alias("registro"),
        F.col("l_partkey").cast("string").alias("conta"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("valor"))
    od = read_table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.col("o_custkey").alias("registro"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("valor"))
    return edge(union_all([li, od]))


@register("x02_keep_first", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders)
WHERE rn = 1
""")
def x02_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.sets import keep_first
    from ..sources.tables import read_table

    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@register("x03_distinct", with_ctes(body="""
SELECT DISTINCT registro_ans, ano, trimestre, data_referencia FROM despesas
"""))
def x03_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.sets import distinct_rows

    fact = expenses_from_testdata(spark, sf_dir)
    return distinct_rows(fact, ["registro_ans", "ano", "trimestre", "data_referencia"])


@register("f01_prefix", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS Conta FROM lineitem
WHERE starts_with(CAST(l_partkey AS VARCHAR), '4')
""")
def f01_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.filters import account_prefix
    from ..sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("Conta"))
    return account_prefix(li, "Conta", "4")


@register("f02_positive", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0
""")
def f02_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.filters import positive
    from ..sources.tables import read_table

    return positive(read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"),
                    "c_acctbal")


# --------------------------------------------------------------------------
# Scalar functions over table-derived text.
# --------------------------------------------------------------------------

@register("c01_number_br", with_ctes(RAW_LEDGER_SQL, body=f"""
SELECT l_orderkey, l_linenumber, VL_SALDO_FINAL,
       CAST({sql_parse_number('VL_SALDO_FINAL', 'br')} AS DOUBLE) AS valor,
       CAST({sql_parse_number("('99999999999' || VL_SALDO_FINAL)", 'br')} AS DOUBLE) AS valor_longo
FROM raw_ledger
"""))
def c01_number_br(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.numbers import parse_number

    raw = raw_ledger(spark, sf_dir)
    return edge(raw.select("l_orderkey", "l_linenumber", "VL_SALDO_FINAL",
                           parse_number(F.col("VL_SALDO_FINAL"), "br").alias("valor"),
                           # mostly beyond the money type: NULL, not 0
                           parse_number(F.concat(F.lit("99999999999"), "VL_SALDO_FINAL"), "br")
                           .alias("valor_longo")))


@register("c02_number_plain", with_ctes(RAW_LEDGER_SQL, body=f"""
SELECT l_orderkey, l_linenumber, VL_SALDO_FINAL,
       CAST({sql_parse_number('VL_SALDO_FINAL', 'plain')} AS DOUBLE) AS valor
FROM raw_ledger
"""))
def c02_number_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.numbers import parse_number

    raw = raw_ledger(spark, sf_dir)
    return edge(raw.select("l_orderkey", "l_linenumber", "VL_SALDO_FINAL",
                           parse_number(F.col("VL_SALDO_FINAL"), "plain").alias("valor")))


@register("c03_decimal", """
SELECT l_orderkey, l_linenumber, t,
       CAST(TRY_CAST(replace(t, ',', '.') AS DECIMAL(15,2)) AS DOUBLE) AS valor
FROM (SELECT l_orderkey, l_linenumber,
             replace(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), '.', ',')
               || CAST(l_linenumber AS VARCHAR) AS t
      FROM lineitem)
""")
def c03_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.numbers import comma_decimal
    from ..sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem")
    text = F.concat(F.replace(F.col("l_extendedprice").cast("decimal(15,2)").cast("string"),
                              F.lit("."), F.lit(",")), F.col("l_linenumber").cast("string"))
    return edge(li.select("l_orderkey", "l_linenumber", text.alias("t")).withColumn(
        "valor", comma_decimal(F.col("t"))))


@register("c04_digits", with_ctes(body="""
SELECT registro_ans, CAST(NULLIF(regexp_replace(cnpj, '[^0-9]', '', 'g'), '') AS BIGINT) AS cnpj_digits
FROM operadoras
"""))
def c04_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import digits_key

    dim = operators_from_testdata(spark, sf_dir)
    return dim.select("registro_ans", digits_key(F.col("cnpj")).alias("cnpj_digits"))


@register("h01_header_normalise", """
SELECT p_partkey,
       replace(replace(translate(upper(trim(p_name)), 'ÇÃÕ', 'CAO'), ' ', '_'), '.', '') AS header
FROM part
""")
def h01_header_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import normalise_header_col
    from ..sources.tables import read_table

    part = read_table(spark, sf_dir, "part")
    return part.select("p_partkey", normalise_header_col(F.col("p_name")).alias("header"))


@register("c07_state", """
SELECT s.s_suppkey AS registro_ans, r AS uf_raw, left(NULLIF(r, 'N/A'), 2) AS uf
FROM (SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN 'N/A' ELSE n.n_name END AS r
      FROM supplier LEFT JOIN nation n ON s_nationkey = n.n_nationkey) s
""")
def c07_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import state_code
    from ..sources.tables import read_table

    sup = read_table(spark, sf_dir, "supplier")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey, "left")
    raw = F.when(F.col("s_nationkey") == 0, F.lit("N/A")).otherwise(F.col("n_name"))
    return j.select(F.col("s_suppkey").alias("registro_ans"), raw.alias("uf_raw")).withColumn(
        "uf", state_code(F.col("uf_raw")))


@register("c08_quarter_start", """
SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(quarter(l_shipdate) AS INTEGER) AS trimestre,
       make_date(CAST(year(l_shipdate) AS INTEGER), (CAST(quarter(l_shipdate) AS INTEGER) - 1) * 3 + 1, 1)
         AS data_referencia
FROM lineitem
""")
def c08_quarter_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = expenses_from_testdata(spark, sf_dir)
    return fact.select("ano", "trimestre", "data_referencia").distinct()


@register("c11_edge_types", with_ctes(body="""
SELECT registro_ans, ano, trimestre, strftime(data_referencia, '%Y-%m-%d') AS data_referencia,
       CAST(valor_despesa AS DOUBLE) AS valor_despesa
FROM despesas
"""))
def c11_edge_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.dates import date_text

    fact = expenses_from_testdata(spark, sf_dir)
    return fact.select("registro_ans", "ano", "trimestre",
                       date_text(F.col("data_referencia")).alias("data_referencia"),
                       F.col("valor_despesa").cast("double").alias("valor_despesa"))


@register("s10_null_tokens", """
SELECT l_orderkey, l_linenumber, t,
       CASE WHEN t IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan',
                       '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a',
                       'nan', 'null') THEN NULL ELSE t END AS valor
FROM (SELECT l_orderkey, l_linenumber,
             CASE l_linenumber WHEN 1 THEN 'NA' WHEN 2 THEN 'NULL' WHEN 3 THEN 'None'
                               WHEN 4 THEN '' WHEN 5 THEN 'N/A' ELSE l_returnflag END AS t
      FROM lineitem)
""")
def s10_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import null_tokens
    from ..sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    t = (F.when(ln == 1, "NA").when(ln == 2, "NULL").when(ln == 3, "None").when(ln == 4, "")
         .when(ln == 5, "N/A").otherwise(F.col("l_returnflag")))
    return li.select("l_orderkey", "l_linenumber", t.alias("t")).withColumn(
        "valor", null_tokens(F.col("t")))


# --------------------------------------------------------------------------
# Links over the pages table.
# --------------------------------------------------------------------------

_LINKS_SQL = r"""
l AS (SELECT page_id, url,
             list_transform(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href="([^"]*)"', 1),
                            lambda h: replace(h, '&amp;', '&')) AS hs
      FROM pages),
x AS (SELECT page_id, url, unnest(hs) AS href, unnest(range(len(hs))) AS pos FROM l),
links AS (SELECT page_id, url, CAST(pos AS INTEGER) AS pos, href FROM x
          WHERE href <> '' AND href <> '../' AND NOT starts_with(href, '?'))
"""


@register("s01_links", "WITH " + _LINKS_SQL.strip() + "\nSELECT page_id, url, pos, href FROM links")
def s01_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.links import extract_links
    from ..sources.tables import read_table

    return extract_links(read_table(spark, sf_dir, "pages"))


@register("s02_resolve", "WITH " + _LINKS_SQL.strip() + r"""
SELECT page_id, pos,
       CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
            WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:)//([^/?#]*)', 1) || href
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:)//([^/?#]*)', 1)
                 || '//' || regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:)//([^/?#]*)', 2) || href
       END AS absolute_url
FROM links
""")
def s02_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.links import extract_links, resolve_links
    from ..sources.tables import read_table

    links = extract_links(read_table(spark, sf_dir, "pages"))
    return resolve_links(links).select("page_id", "pos", "absolute_url")


PICK_KEYWORDS = ("the",)


@register("s03_pick", r"""
SELECT page_id,
       coalesce(list_filter(list_transform(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href="([^"]*)"', 1),
                                           lambda h: replace(h, '&amp;', '&')),
                            lambda h: h <> '' AND h <> '../' AND NOT starts_with(h, '?')
                                 AND contains(lower(h), 'the'))[1], 'N/A') AS picked,
       list_filter(list_transform(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href="([^"]*)"', 1),
                                  lambda h: replace(h, '&amp;', '&')),
                   lambda h: h <> '' AND h <> '../' AND NOT starts_with(h, '?') AND ends_with(lower(h), 'e')
                        AND (contains(lower(h), 'the') OR contains(lower(h), 'de')))[1] AS picked_file
FROM pages
""")
def s03_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.links import link_array, pick_link
    from ..sources.tables import read_table

    pages = read_table(spark, sf_dir, "pages")
    arr = link_array(F.col("html"))
    return pages.select(
        "page_id",
        pick_link(arr, PICK_KEYWORDS, "all", fallback="N/A").alias("picked"),
        pick_link(arr, (*PICK_KEYWORDS, "de"), "any", suffix="e").alias("picked_file"))


_PERIOD_LINKS_SQL = r"""
pl AS (SELECT l_orderkey, l_linenumber,
              CASE l_returnflag
                WHEN 'R' THEN CAST(year(l_shipdate) AS VARCHAR) || '/' || CAST(quarter(l_shipdate) AS VARCHAR)
                              || 't' || CAST(year(l_shipdate) AS VARCHAR) || '.zip'
                WHEN 'N' THEN CAST(year(l_shipdate) AS VARCHAR) || '/' || CAST(quarter(l_shipdate) AS VARCHAR)
                              || 'T' || CAST(year(l_shipdate) AS VARCHAR) || '.zip'
                ELSE 'leia-me.txt' END AS link
       FROM lineitem),
pp AS (SELECT l_orderkey, l_linenumber, link,
              CAST(NULLIF(regexp_extract(link, '(\d{4})', 1), '') AS INTEGER) AS ano,
              CAST(NULLIF(regexp_extract(link, '(?i)(\d)T', 1), '') AS INTEGER) AS trimestre
       FROM pl)
"""


def period_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem")
    y = F.year("l_shipdate").cast("string")
    q = F.quarter("l_shipdate").cast("string")
    link = (F.when(F.col("l_returnflag") == "R", F.concat(y, F.lit("/"), q, F.lit("t"), y, F.lit(".zip")))
            .when(F.col("l_returnflag") == "N", F.concat(y, F.lit("/"), q, F.lit("T"), y, F.lit(".zip")))
            .otherwise(F.lit("leia-me.txt")))
    return li.select("l_orderkey", "l_linenumber", link.alias("link"))


@register("s04_period", "WITH " + _PERIOD_LINKS_SQL.strip() + """
SELECT l_orderkey, l_linenumber, link, ano, trimestre FROM pp
WHERE ano IS NOT NULL AND trimestre IS NOT NULL
""")
def s04_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.links import with_period

    return with_period(period_links(spark, sf_dir), "link")


@register("s05_latest_periods", "WITH " + _PERIOD_LINKS_SQL.strip() + """
SELECT DISTINCT ano, trimestre FROM pp WHERE ano IS NOT NULL AND trimestre IS NOT NULL
ORDER BY ano DESC, trimestre DESC LIMIT 3
""")
def s05_latest_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.links import latest_periods, with_period

    return latest_periods(with_period(period_links(spark, sf_dir), "link"), 3)


# --------------------------------------------------------------------------
# Envelopes (R1, R4): one row holding arrays, exploded to rows for the check.
# --------------------------------------------------------------------------

@register("r01_listing", with_ctes(body=f"""
hits AS (SELECT registro_ans, cnpj, razao_social, uf FROM operadoras
         WHERE razao_social ILIKE '%{SEARCH_TERM}%' OR cnpj ILIKE '%{SEARCH_TERM}%'),
p AS (SELECT * FROM hits ORDER BY registro_ans LIMIT 10 OFFSET 10),
n AS (SELECT COUNT(*) AS total FROM hits)
SELECT n.total, CAST(2 AS INTEGER) AS page, CAST(10 AS INTEGER) AS "limit",
       CAST(row_number() OVER (ORDER BY p.registro_ans) - 1 AS INTEGER) AS pos,
       p.registro_ans, p.cnpj, p.razao_social, p.uf
FROM p, n
""").replace("\nhits AS", ",\nhits AS", 1))
def r01_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import listing

    page = listing(operators_from_testdata(spark, sf_dir), SEARCH_TERM, page_no=2, limit=10)
    return page.select("total", "page", "limit", F.posexplode("data").alias("pos", "d")).select(
        "total", "page", "limit", "pos", "d.*")


@register("r04_statistics", with_ctes(body=f"""
t AS (SELECT registro_ans, SUM(valor_despesa) AS total FROM despesas GROUP BY registro_ans),
ops AS (SELECT o.razao_social AS nome, t.total,
               row_number() OVER (ORDER BY t.total DESC, t.registro_ans) AS r
        FROM t JOIN operadoras o ON t.registro_ans = o.registro_ans),
ufs AS (SELECT uf AS nome, total, row_number() OVER (ORDER BY total DESC, uf) AS r
        FROM (SELECT o.uf, SUM(t.total) AS total FROM t JOIN operadoras o ON t.registro_ans = o.registro_ans
              WHERE o.uf IS NOT NULL GROUP BY o.uf))
SELECT 'total_despesas' AS parte, CAST(0 AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS nome,
       CAST(coalesce(SUM(total), 0) AS DOUBLE) AS valor FROM t
UNION ALL
SELECT 'media_por_operadora', 0, NULL, coalesce({sql_half_up_ratio("SUM(total) * 100", "COUNT(*)", 1)}, 0) FROM t
UNION ALL
SELECT 'top_5_operadoras', CAST(r - 1 AS INTEGER), nome, CAST(total AS DOUBLE) FROM ops WHERE r <= 5
UNION ALL
SELECT 'top_estados', CAST(r - 1 AS INTEGER), nome, CAST(total AS DOUBLE) FROM ufs WHERE r <= 10
""").replace("\nt AS", ",\nt AS", 1))
def r04_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.serving import statistics

    dim, fact = dim_fact(spark, sf_dir)
    pair = "array<struct<nome:string,total:double>>"

    def single(name: str):
        return F.array(F.struct(F.lit(None).cast("string").alias("nome"), F.col(name).alias("total"))).cast(pair)

    parts = F.create_map(
        F.lit("total_despesas"), single("total_despesas"),
        F.lit("media_por_operadora"), single("media_por_operadora"),
        F.lit("top_5_operadoras"), F.col("top_5_operadoras").cast(pair),
        F.lit("top_estados"), F.col("top_estados").cast(pair))
    return (statistics(fact, dim).select(F.explode(parts).alias("parte", "pairs"))
            .select("parte", F.posexplode("pairs").alias("pos", "p"))
            .select("parte", "pos", F.col("p.nome").alias("nome"), F.col("p.total").alias("valor")))


@register("v05_domain", """
SELECT s_suppkey AS registro_ans, s_name AS razao_social, n_name AS uf_raw,
       length(s_name) > 255 AS razao_social_too_long,
       length(n_name) > 2 AS uf_raw_too_long
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
WHERE coalesce(length(s_name) > 255, false) OR coalesce(length(n_name) > 2, false)
""")
def v05_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry text checked against the warehouse column domains before the
    load (V5): the raw state text (nation name) breaks ``CHAR(2)``."""
    from ..operators.quality import domain_violations
    from ..sources.tables import read_table

    sup = read_table(spark, sf_dir, "supplier")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    raw = sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey, "left").select(
        F.col("s_suppkey").alias("registro_ans"), F.col("s_name").alias("razao_social"),
        F.col("n_name").alias("uf_raw"))
    return domain_violations(raw, {"razao_social": 255, "uf_raw": 2})


# --------------------------------------------------------------------------
# Files written out of the driver tables and read back (S7, S8, H1-H5, R9;
# K1, K3, K4).
# --------------------------------------------------------------------------

@register("s08_layouts", ORACLE["r09_consolidate"])
def s08_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ledger as loose files of two dialects and column orders, beside
    files without a value column, consolidated from the folder: the same rows
    as from the table."""
    from ..plans.consolidate import canonical_ledger, consolidate
    from ..sources.delimited import period_from_path, read_layouts

    folder = scratch_folder(spark, "s08")
    raw = raw_ledger(spark, sf_dir).withColumn(
        "quarter", F.concat(F.col("ano").cast("string"), F.lit("_T"), F.col("trimestre").cast("string")))
    odd = F.col("l_orderkey") % 2 == 1
    account, value, op = F.col("CD_CONTA_CONTABIL"), F.col("VL_SALDO_FINAL"), F.col("REG_ANS")
    note = F.lit("Saúde").alias("OBSERVAÇÃO")

    def write(df: DataFrame, name: str, sep: str, encoding: str) -> None:
        (df.hint("rebalance", "quarter").write.partitionBy("quarter").option("header", "true")
         .option("sep", sep).option("encoding", encoding).option("escape", '"').csv(f"{folder}/{name}"))

    write(raw.filter(odd).select(op, account, note, value, "quarter"), "a", ";", "ISO-8859-1")
    write(raw.filter(~odd).select(note, value.alias("VALOR"), op.alias("CD_OPS"), account, "quarter"),
          "b", ",", "UTF-8")
    write(raw.filter(odd).groupBy(op, "quarter").agg(F.first(account).alias("CD_CONTA_CONTABIL")),
          "c", ";", "UTF-8")
    shaped = [canonical_ledger(period_from_path(f, "_source_path", r"(\d{4})_T(\d)").drop("_source_path"),
                               period_cols=("ano", "trimestre")) for f in read_layouts(spark, folder)]
    return edge(consolidate(shaped))


@register("k01_delimited_sink", """
SELECT s_suppkey, s_name || ' "a;b"; "' AS texto, CAST(s_acctbal AS DOUBLE) AS saldo FROM supplier
""")
def k01_delimited_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with quotes and separators, written and read back (K1, K2)."""
    from ..sinks.tables import write_delimited
    from ..sources.tables import read_table

    path = scratch_folder(spark, "k01")
    sup = read_table(spark, sf_dir, "supplier")
    write_delimited(sup.select("s_suppkey", F.concat("s_name", F.lit(' "a;b"; "')).alias("texto"),
                               F.col("s_acctbal").alias("saldo")), path, compression="gzip")
    back = (spark.read.option("header", "true").option("sep", ";").option("escape", '"')
            .schema("s_suppkey bigint, texto string, saldo double").csv(path))
    return back.select("s_suppkey", "texto", "saldo")


def stored_fact(spark: SparkSession, sf_dir: str, key: str) -> tuple[DataFrame, str]:
    from ..sinks.tables import write_fact

    path = scratch_folder(spark, key)
    fact = expenses_from_testdata(spark, sf_dir)
    write_fact(fact, path)
    return fact, path


@register("k03_reload", with_ctes(body="""
SELECT ano, trimestre, COUNT(*) AS n_rows, CAST(SUM(valor_despesa) AS DOUBLE) AS total
FROM despesas GROUP BY ano, trimestre
"""))
def k03_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a second load of every first quarter: equal to the first load (K3)."""
    from ..sinks.tables import write_fact

    fact, path = stored_fact(spark, sf_dir, "k03")
    write_fact(fact.filter(F.col("trimestre") == 1), path, dynamic=True)
    return edge(spark.read.parquet(path).groupBy("ano", "trimestre").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("valor_despesa").alias("total")))


@register("k04_period_folders", with_ctes(body="""
SELECT registro_ans, COUNT(*) AS n_rows, CAST(SUM(valor_despesa) AS DOUBLE) AS total
FROM despesas WHERE ano = 1995 AND trimestre = 2 GROUP BY registro_ans
"""))
def k04_period_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quarter of the stored fact: only its folder is read (K4)."""
    _, path = stored_fact(spark, sf_dir, "k04")
    quarter = spark.read.parquet(path).filter("ano = 1995 AND trimestre = 2")
    return edge(quarter.groupBy("registro_ans").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("valor_despesa").alias("total")))


@register("s06_archives", ORACLE["r09_consolidate"])
def s06_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger from ZIP archives written from the line items (S6, K2): an
    archive a quarter and so many rows of it, members in two layouts with quoted line breaks, and
    members that the scan skips by name or kind."""
    from ..plans.consolidate import canonical_ledger, consolidate
    from ..sinks.archives import member_lines, write_archives
    from ..sources.archives import archive_records, parse_members
    from ..sources.delimited import period_from_path

    folder = scratch_folder(spark, "s06")
    raw = raw_ledger(spark, sf_dir).withColumn("NOTA", F.lit('fim "de\nlinha"; ok'))
    quarters = raw.select("ano", "trimestre").distinct().count()
    split = math.ceil(raw.count() / max(1, quarters) / ARCHIVE_ROWS) or 1
    bucket = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(split)).cast("string")
    archive = F.concat(F.col("ano").cast("string"), F.lit("_T"), F.col("trimestre").cast("string"), F.lit("/q"), bucket, F.lit(".zip"))
    part = (F.col("l_orderkey") % 4).cast("string")
    odd = F.col("l_orderkey") % 2 == 1
    swapped = raw.filter(~odd).withColumns({"VALOR": F.col("VL_SALDO_FINAL"), "CD_OPS": F.col("REG_ANS")})
    lines = (
        member_lines(raw.filter(odd), archive, F.concat(F.lit("d/"), part, F.lit(".csv")),
                     ["REG_ANS", "NOTA", "CD_CONTA_CONTABIL", "VL_SALDO_FINAL"])
        .union(member_lines(swapped, archive, F.concat(part, F.lit(".CSV")),
                            ["VALOR", "CD_CONTA_CONTABIL", "CD_OPS"], sep=","))
        .union(member_lines(raw, archive, F.lit("receitas.csv"), ["REG_ANS", "VL_SALDO_FINAL"]))
        .union(member_lines(raw, archive, F.lit("leia.txt"), ["REG_ANS"])))
    write_archives(lines, folder, partitions=2 * quarters * split or 1)
    records = archive_records(spark, folder)
    stored = scratch_folder(spark, "s06")
    records.write.parquet(stored)
    shaped = []
    for frame in parse_members(spark.read.parquet(stored)):
        frame = period_from_path(frame, "_source_path").drop("_source_path")
        shaped.append(canonical_ledger(frame, period_cols=("ano", "trimestre")))
    return edge(consolidate(shaped))


@register("s08_split_records", ORACLE["r09_consolidate"])
def s08_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger from quoted files whose notes hold separators, quotes and
    line breaks, each file read by as many tasks as it has pieces (S8)."""
    from ..plans.consolidate import canonical_ledger, consolidate
    from ..sources.delimited import period_from_path, read_layouts

    folder = scratch_folder(spark, "s08q")
    quarter = F.concat(F.col("ano").cast("string"), F.lit("_T"), F.col("trimestre").cast("string"))
    note = F.concat(F.lit('obs; "item"\n'), F.col("CD_CONTA_CONTABIL"), F.lit('\r\n"",;fim'))
    (raw_ledger(spark, sf_dir).select("REG_ANS", note.alias("NOTA"), "CD_CONTA_CONTABIL", "VL_SALDO_FINAL", quarter.alias("quarter"))
     .hint("rebalance", "quarter").write.partitionBy("quarter").option("header", "true").option("sep", ";").option("escape", '"').csv(folder))
    shaped = [canonical_ledger(period_from_path(f, "_source_path", r"(\d{4})_T(\d)").drop("_source_path"),
                               period_cols=("ano", "trimestre")) for f in read_layouts(spark, folder)]
    return edge(consolidate(shaped))


@register("s10_scan", """
SELECT CAST(o_orderkey AS VARCHAR) AS chave,
       CASE WHEN o_orderkey % 4 = 0 THEN 'a;"b"' || chr(10) || 'c' END AS nota,
       CASE WHEN o_orderkey % 4 IN (0, 3) THEN o_orderstatus END AS situacao
FROM orders WHERE o_orderkey % 4 <> 1
""")
def s10_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tolerant scan (S10): quoted separators and line breaks kept, rows with
    too many fields dropped, short rows filled, missing-value tokens NULL."""
    from ..sources.delimited import read_tolerant
    from ..sources.tables import read_table

    folder = scratch_folder(spark, "s10")
    key, status, kind = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderkey") % 4
    line = (F.when(kind == 0, F.concat(key, F.lit(';"a;""b""\nc";'), status))
            .when(kind == 1, F.concat(key, F.lit(';x;y;"too\nlong"')))
            .when(kind == 2, key)
            .otherwise(F.concat(key, F.lit(";NA;"), status)))
    rows = read_table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 8).alias("part"), F.lit(1).alias("ord"), line.alias("line"))
    heads = spark.range(8).select(F.col("id").alias("part"), F.lit(0).alias("ord"), F.lit("chave;nota;situacao").alias("line"))
    (rows.union(heads).repartition(8, "part").sortWithinPartitions("part", "ord").drop("ord")
     .write.partitionBy("part").text(folder))
    return read_tolerant(spark, folder)


@register("s07_selection", """
SELECT CAST(s_suppkey AS VARCHAR) AS chave, s_name AS nome FROM supplier
""")
def s07_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in nested folders, of which those with unwanted names or kinds are left out."""
    from ..sources.delimited import read_layouts
    from ..sources.files import move_single
    from ..sources.tables import read_table

    folder = scratch_folder(spark, "s07")
    sup = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("chave"), F.col("s_name").alias("nome"))
    for name, rows in (("2023/a/Despesas.CSV", sup.filter("chave % 2 = 0")), ("2023/despesas_b.csv", sup.filter("chave % 2 = 1")),
                       ("2023/a/RECEITAS_1.csv", sup), ("Ativos.csv", sup), ("2023/despesas.txt", sup)):
        part = scratch_folder(spark, "s07-part")
        rows.coalesce(1).write.option("header", "true").option("sep", ";").csv(part)
        move_single(spark, part, f"{folder}/{name}")
    (frame,) = read_layouts(spark, folder)
    return frame.drop("_source_path")


@register("s12_staging", """
SELECT 'operadoras' AS tabela, COUNT(*) AS n_rows, CAST(SUM(s_suppkey) AS BIGINT) AS total FROM supplier
UNION ALL SELECT 'despesas', COUNT(*), CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * 100 AS BIGINT)) AS BIGINT) FROM lineitem
UNION ALL SELECT 'agregadas', COUNT(*), CAST(SUM(t) AS BIGINT) FROM (
  SELECT SUM(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * 100 AS BIGINT)) AS t FROM lineitem GROUP BY l_suppkey)
""")
def s12_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files of declared text columns, loaded as staging tables."""
    from ..functions.numbers import comma_decimal
    from ..sinks.tables import write_delimited
    from ..sources.delimited import read_staging
    from ..sources.tables import read_table

    folder = scratch_folder(spark, "s12")
    comma = F.translate(F.col("l_extendedprice").cast("decimal(15,2)").cast("string"), ".", ",")
    cents = F.sum((F.col("l_extendedprice").cast("decimal(15,2)") * 100).cast("long"))
    items = read_table(spark, sf_dir, "lineitem")
    tables = {
        "operadoras": read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("registro"), F.col("s_name").alias("nome")),
        "despesas": items.select(F.col("l_suppkey").alias("registro"), comma.alias("valor")),
        "agregadas": items.groupBy(F.col("l_suppkey").alias("registro")).agg(cents.alias("total")),
    }
    out = []
    for name, df in tables.items():
        write_delimited(df, f"{folder}/{name}")
        schema = StructType([StructField(c, StringType()) for c in df.columns])
        staged = read_staging(spark, f"{folder}/{name}", schema)
        number = {"operadoras": F.col("registro").cast("long"), "agregadas": F.col(df.columns[-1]).cast("long"),
                  "despesas": (comma_decimal(F.col(df.columns[-1])) * 100).cast("long")}[name]
        out.append(staged.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("total")))
    return out[0].union(out[1]).union(out[2]).select("tabela", "n_rows", "total")


@register("c06_accent_headers", ORACLE["r09_consolidate"])
def c06_accent_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger under accented, spaced and dotted headers that fold to its names."""
    from ..plans.consolidate import canonical_ledger, consolidate

    raw = raw_ledger(spark, sf_dir)
    named = raw.select(
        F.col("REG_ANS").alias(" Registro Ans"), F.col("CD_CONTA_CONTABIL").alias("cd.cõntã.çontãbil"),
        F.col("VL_SALDO_FINAL").alias("Vl. Sãldo Finãl "), "ano", "trimestre")
    named = named.withColumnRenamed("cd.cõntã.çontãbil", "cd cõntã çontãbil")
    return edge(consolidate([canonical_ledger(named, period_cols=("ano", "trimestre"))]))


@register("t01_ranked_export", with_ctes(RAW_LEDGER_SQL, CONSOLIDATED_SQL, REGISTRY_SQL, body=f"""
SELECT row_number() OVER (ORDER BY ValorTotal DESC, RegistroANS) AS pos, RegistroANS, ValorTotal
FROM (SELECT * FROM ({_MART_SQL}))
"""))
def t01_ranked_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every operator in the exported file."""
    from ..operators.ordering import asc, desc, ranked
    from ..plans.mart import operator_mart
    from ..sinks.tables import write_delimited
    from ..sources.delimited import read_ranked

    path = scratch_folder(spark, "t01")
    mart = operator_mart(consolidated(spark, sf_dir), registry(spark, sf_dir)).select("RegistroANS", "ValorTotal")
    write_delimited(ranked(mart, [desc("ValorTotal"), asc("RegistroANS")]), path, compression="gzip")
    return read_ranked(spark, path, "RegistroANS string, ValorTotal double").select("pos", "RegistroANS", "ValorTotal")


@register("k03_refresh_all", with_ctes(body="""
SELECT 'operadoras' AS tabela, COUNT(*) AS n_rows, CAST(SUM(registro_ans) AS DOUBLE) AS total FROM operadoras
UNION ALL SELECT 'despesas', COUNT(*), CAST(SUM(valor_despesa) AS DOUBLE) FROM despesas
UNION ALL SELECT 'agregadas', COUNT(DISTINCT registro_ans), CAST(SUM(valor_despesa) AS DOUBLE) FROM despesas
"""))
def k03_refresh_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension, fact and mart after an old version, a full refresh of all
    three, and a refresh that stops after the dimension (K3): the second holds."""
    from ..sinks.snapshots import Snapshots
    from ..sinks.tables import write_fact, write_lookup, write_table

    dim, fact = dim_fact(spark, sf_dir)
    snapshots = Snapshots(spark, scratch_folder(spark, "k03all"))

    def refresh(dim: DataFrame, fact: DataFrame, complete: bool = True) -> None:
        version = snapshots.begin()
        write_lookup(dim, version.table("dimension"), ["registro_ans"])
        if complete:
            write_fact(fact, version.table("fact"))
            mart = fact.groupBy("registro_ans").agg(F.sum("valor_despesa").alias("total"))
            write_table(mart, version.table("mart"))
            snapshots.commit(version, ["dimension", "fact", "mart"])

    refresh(dim.filter("registro_ans % 2 = 0"), fact.filter("trimestre = 1"))
    refresh(dim, fact)
    refresh(dim.filter("registro_ans % 3 = 0"), fact, complete=False)
    counts = [snapshots.read(t).agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("n_rows"), F.sum(c).cast("double").alias("total"))
              for t, name, c in (("dimension", "operadoras", "registro_ans"), ("fact", "despesas", "valor_despesa"), ("mart", "agregadas", "total"))]
    return counts[0].union(counts[1]).union(counts[2])


@register("s09_spreadsheet", """
SELECT CAST(o_orderkey AS VARCHAR) AS chave, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS data,
       CAST(o_totalprice AS DOUBLE) AS total, CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END AS aberto,
       'São <' || o_orderpriority || '>' AS nota, strftime(o_orderdate, '%Y-%m-%d') || ' 12:34:56' AS hora
FROM orders
""")
def s09_spreadsheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cells of workbooks written from the orders, read back as text."""
    from ..sinks.workbooks import write_workbooks
    from ..sources.archives import parse_members, read_spreadsheets
    from ..sources.tables import read_table

    folder = scratch_folder(spark, "s09")
    rows = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("chave"), F.col("o_orderdate").cast("date").alias("data"),
        F.col("o_totalprice").cast("double").alias("total"), (F.col("o_orderstatus") == "O").alias("aberto"),
        F.concat(F.lit("São <"), "o_orderpriority", F.lit(">")).alias("nota"),
        F.to_timestamp(F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" 12:34:56"))).alias("hora"))
    # a sheet holds 1,048,576 rows at most
    books = max(12, math.ceil(rows.count() / SHEET_ROWS))
    write_workbooks(rows, folder, F.concat((F.col("chave") % books).cast("string"), F.lit("/livro.xlsx")), partitions=2 * books)
    stored = scratch_folder(spark, "s09")
    read_spreadsheets(spark, folder).write.parquet(stored)
    (frame,) = parse_members(spark.read.parquet(stored))
    return frame.drop("_source_path").withColumn("total", F.col("total").cast("double"))


SEARCH_TERMS = ("supplier#00000001", "ER#0000000", "0001", "9-", "%00_05%", "#", "nothing like it", "12", "/0000")
_TERMS_SQL = ", ".join(f"('{t}')" for t in SEARCH_TERMS)


@register("f04_search_index", with_ctes(body=f"""
SELECT term, registro_ans, cnpj, razao_social FROM operadoras, (VALUES {_TERMS_SQL}) AS v(term)
WHERE razao_social ILIKE '%' || term || '%' OR cnpj ILIKE '%' || term || '%'
"""))
def f04_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every operator found for each of several terms, through trigram postings of the dimension."""
    from ..operators.search_index import SearchIndex
    from ..operators.sets import union_all
    from ..sinks.tables import write_lookup

    folder = scratch_folder(spark, "f04")
    write_lookup(operators_from_testdata(spark, sf_dir), f"{folder}/dimension", ["registro_ans"])
    dim = spark.read.parquet(f"{folder}/dimension")
    index = SearchIndex.build(dim, f"{folder}/search")
    return union_all([index.search(dim, t).select(F.lit(t).alias("term"), "registro_ans", "cnpj", "razao_social") for t in SEARCH_TERMS])
