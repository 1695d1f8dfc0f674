"""Enrichment and operator mart.

ledger (RegistroANS, Ano, Trimestre, ValorDespesas) ⟕ registry on cleaned
keys, label fill, tax-id flag, per-operator profile, ranked by total.

Plan: the registry is first made unique per key (X2), which makes the group
keys (RegistroANS, CNPJ, RazaoSocial, UF) a function of RegistroANS. So the
ledger is aggregated per cleaned key *before* the join: partial aggregation in
every scan task, one shuffle of one row per key per task, then a join of two
per-operator tables. The tax-id check runs once per operator, not per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.taxid import cnpj_is_valid
from ..functions.text import clean_key, unknown_operator_label
from ..operators.ordering import asc, desc, ranked
from ..operators.sets import keep_first

MART_COLUMNS = ("RegistroANS", "CNPJ", "RazaoSocial", "UF", "ValorTotal", "MediaTrimestral",
                "DesvioPadrao", "QtdRegistros")


def unique_registry(registry: DataFrame) -> DataFrame:
    """One registry row per cleaned key, chosen deterministically."""
    reg = registry.withColumn("RegistroANS", clean_key(F.col("RegistroANS").cast("string")))
    reg = reg.filter(F.col("RegistroANS").isNotNull())
    return keep_first(reg, ["RegistroANS"], ["CNPJ", "RazaoSocial", "Modalidade", "UF"])


def operator_mart(ledger: DataFrame, registry: DataFrame, sort: bool = True,
                  with_flag: bool = False) -> DataFrame:
    """Operator mart: total, mean per row, sample std (0 for one row), rows.

    Rows whose key is NULL are left out of the groups (D4). Expenses with no
    registry row stay, labelled ``Operadora <key> Desconhecida`` (D3, D23).
    ``with_flag`` adds ``CNPJ_Valido`` (V1), which the reference computes and
    then loses in the aggregation (D8).
    """
    led = ledger.select(
        clean_key(F.col("RegistroANS").cast("string")).alias("RegistroANS"),
        F.col("ValorDespesas").alias("v"),
    ).filter(F.col("RegistroANS").isNotNull())
    per_key = led.groupBy("RegistroANS").agg(
        F.sum("v").alias("ValorTotal"),
        F.count("v").alias("QtdRegistros"),
        F.stddev_samp("v").alias("_std"),
    )
    reg = unique_registry(registry).select("RegistroANS", "CNPJ", "RazaoSocial", "UF")
    # both sides are one row per operator and exist only after aggregations:
    # AQE picks broadcast or shuffle join from their measured sizes
    joined = per_key.join(reg, "RegistroANS", "left")
    mart = joined.select(
        "RegistroANS",
        F.coalesce("CNPJ", F.lit("N/A")).alias("CNPJ"),
        F.coalesce("RazaoSocial", unknown_operator_label(F.col("RegistroANS"))).alias("RazaoSocial"),
        F.coalesce("UF", F.lit("N/A")).alias("UF"),
        "ValorTotal",
        F.round(F.col("ValorTotal") / F.col("QtdRegistros").cast("decimal(20,0)"), 2)
        .alias("MediaTrimestral"),
        F.round(F.coalesce(F.col("_std"), F.lit(0.0)), 2).alias("DesvioPadrao"),
        "QtdRegistros",
    )
    if with_flag:
        mart = mart.withColumn("CNPJ_Valido", cnpj_is_valid("CNPJ"))
    if sort:
        mart = ranked(mart, [desc("ValorTotal"), asc("RegistroANS")])
    return mart


def enriched_ledger(ledger: DataFrame, registry: DataFrame, stored: str | None = None) -> DataFrame:
    """Row-level enriched ledger with the tax-id flag kept.

    With ``stored`` (a path on shared storage) the unique registry is written
    there once, measured, and broadcast when it is within the bound, so the
    ledger rows are not shuffled on a skewed key; beyond the bound, and
    without ``stored``, AQE chooses the join.
    """
    from ..operators.joins import left_enrich

    reg = unique_registry(registry).select("RegistroANS", "CNPJ", "RazaoSocial", "UF", "Modalidade")
    if stored:
        reg.write.mode("overwrite").parquet(stored)
        reg = ledger.sparkSession.read.parquet(stored)
    out = left_enrich(ledger, reg, "RegistroANS", check_size=bool(stored))
    return out.withColumn("CNPJ_Valido", cnpj_is_valid("CNPJ"))
