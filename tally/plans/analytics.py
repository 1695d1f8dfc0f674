"""The three analytical queries over the star schema.

Inputs are the operator dimension ``dim`` (registro_ans, razao_social, uf, ...)
and the expense fact ``fact`` (registro_ans, ano, trimestre, data_referencia,
valor_despesa). Results keep exact decimals; callers convert at the edge.

Shape of every plan: aggregate the fact per operator first (partial
aggregation in each scan task, one shuffle keyed by operator), and only then
join the dimension. The join then sees one row per operator instead of one
row per ledger line, so it is small whatever the fact size, and a hot operator
is collapsed before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import above_period_mean, per_member_mean
from ..operators.ordering import asc, desc, top_k
from ..operators.windows import first_last, growth_pct


def growth_top(fact: DataFrame, dim: DataFrame, k: int = 5, grain: str = "row") -> DataFrame:
    """Operators with the largest growth from first to last period (R6; W1-W3, F6, T2).

    ``grain='row'`` keeps the reference's row-level first/last value (ties on
    the date broken by the smallest value, decision D9). ``grain='quarter'``
    first sums each operator-quarter and compares quarter totals (A8).
    Operators whose first value is not > 0 are left out (F6).
    """
    if grain == "quarter":
        base = fact.groupBy("registro_ans", "data_referencia").agg(
            F.sum("valor_despesa").alias("valor_despesa")
        )
    elif grain == "row":
        base = fact.select("registro_ans", "data_referencia", "valor_despesa")
    else:
        raise ValueError("grain must be 'row' or 'quarter'")
    ends = first_last(base, "registro_ans", "data_referencia", "valor_despesa")
    ends = ends.filter(F.col("valor_inicial") > 0)
    named = ends.join(dim.select("registro_ans", "razao_social"), "registro_ans", "inner")
    out = named.select(
        "registro_ans", "razao_social", "valor_inicial", "valor_final",
        growth_pct(F.col("valor_inicial"), F.col("valor_final")).alias("crescimento_pct"),
    )
    return top_k(out, [desc("crescimento_pct"), asc("registro_ans")], k)


def growth_all(fact: DataFrame, grain: str = "quarter") -> DataFrame:
    """First/last per operator and growth for every operator, no guard.

    A zero first value gives a NULL growth instead of a division error.
    """
    if grain == "quarter":
        base = fact.groupBy("registro_ans", "data_referencia").agg(
            F.sum("valor_despesa").alias("valor_despesa")
        )
    else:
        base = fact.select("registro_ans", "data_referencia", "valor_despesa")
    ends = first_last(base, "registro_ans", "data_referencia", "valor_despesa")
    return ends.select(
        "registro_ans", "valor_inicial", "valor_final",
        growth_pct(F.col("valor_inicial"), F.col("valor_final")).alias("crescimento_pct"),
    )


def state_totals(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Total per state and mean per operator in the state.

    ``media_por_operadora = round(total / count(distinct operator), 2)``.
    """
    per_op = fact.groupBy("registro_ans").agg(F.sum("valor_despesa").alias("_total"))
    states = dim.filter(F.col("uf").isNotNull()).select("registro_ans", "uf")
    joined = per_op.join(states, "registro_ans", "inner")
    by_state = joined.groupBy("uf").agg(
        F.sum("_total").alias("despesa_total_estado"),
        F.count_distinct("registro_ans").alias("qtd_operadoras"),
    )
    return by_state.select(
        "uf", "despesa_total_estado",
        per_member_mean(F.col("despesa_total_estado"), F.col("qtd_operadoras")).alias(
            "media_por_operadora"
        ),
    )


def top_states(fact: DataFrame, dim: DataFrame, k: int = 5) -> DataFrame:
    """Top-k states by total expense with the mean per operator."""
    return top_k(state_totals(fact, dim), [desc("despesa_total_estado"), asc("uf")], k)


def above_mean(fact: DataFrame, dim: DataFrame, min_count: int = 2,
               count: str = "rows") -> DataFrame:
    """Operators above their period mean at least ``min_count`` times.

    ``count='rows'`` counts ledger rows above the mean (what the reference
    computes, decision D10); ``count='quarters'`` counts distinct quarters
    with at least one row above (what its title says).
    """
    per_op = above_period_mean(fact)
    col = {"rows": "rows_above", "quarters": "periods_above"}[count]
    hits = per_op.filter(F.col(col) >= min_count).select(
        "registro_ans", F.col(col).alias("qtd_trimestres_acima")
    )
    return hits.join(dim.select("registro_ans", "razao_social"), "registro_ans", "inner")
