"""Warehouse load (R11): staging text -> dimension, fact and mart tables.

* dimension: key = digits of the registry key as an integer (C4); rows with
  no usable key are quarantined, not fatal (D13); one row per key chosen
  deterministically (X2, D12); state cleaned (C7, D5).
* fact: key digits -> integer, inner join to the known operators (J3),
  quarter start date (C8), ``replace(',', '.')`` then exact decimal (C3).
* mart: positional text columns cast to their types.

Writes (K3, K4) are in :mod:`tally.sinks.tables`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import quarter_start
from ..functions.numbers import MONEY, comma_decimal
from ..functions.text import digits_key, digits_only, state_code
from ..operators.joins import join_dimension
from ..operators.sets import keep_first

DIM_COLUMNS = ("registro_ans", "cnpj", "razao_social", "modalidade", "uf")
FACT_COLUMNS = ("registro_ans", "ano", "trimestre", "data_referencia", "valor_despesa")


def load_dimension(staging: DataFrame, key_type: str = "bigint") -> tuple[DataFrame, DataFrame]:
    """Staging registry (RegistroANS, CNPJ, RazaoSocial, Modalidade, UF as text)
    -> (dimension, quarantined rows)."""
    keyed = staging.select(
        digits_key(F.col("RegistroANS"), key_type).alias("registro_ans"),
        F.col("CNPJ").alias("cnpj"),
        F.col("RazaoSocial").alias("razao_social"),
        F.col("Modalidade").alias("modalidade"),
        state_code(F.col("UF")).alias("uf"),
        F.col("RegistroANS").alias("_raw_key"),
    )
    bad = keyed.filter(F.col("registro_ans").isNull()).withColumn("reason", F.lit("null_key"))
    good = keyed.filter(F.col("registro_ans").isNotNull()).drop("_raw_key")
    dim = keep_first(good, ["registro_ans"], ["cnpj", "razao_social", "modalidade", "uf"])
    # the digits-only tax id is stored so lookups by tax id (R2, R3) are a
    # plain equality that reaches the parquet scan
    return dim.select(*DIM_COLUMNS, digits_only(F.col("cnpj")).alias("cnpj_digits")), bad


def load_fact(staging: DataFrame, dim: DataFrame, key_type: str = "bigint",
              strict: bool = True, check_size: bool = True) -> DataFrame:
    """Staging ledger (RegistroANS, Ano, Trimestre, ValorDespesas as text) -> fact rows
    of known operators. ``strict`` raises on a malformed amount like the load does.

    ``check_size`` probes a stored dimension before broadcasting its keys;
    pass ``False`` when ``dim`` is still a derived plan (the planner's
    estimate and AQE decide instead of running it an extra time)."""
    rows = staging.select(
        digits_key(F.col("RegistroANS").cast("string"), key_type).alias("registro_ans"),
        F.col("Ano").cast("int").alias("ano"),
        F.col("Trimestre").cast("int").alias("trimestre"),
        comma_decimal(F.col("ValorDespesas").cast("string"), MONEY, strict).alias("valor_despesa"),
    )
    keys = dim.select("registro_ans")
    known = (join_dimension(rows, keys, "registro_ans", "inner") if check_size
             else rows.join(keys, "registro_ans", "inner"))
    return known.select(
        "registro_ans", "ano", "trimestre",
        quarter_start(F.col("ano"), F.col("trimestre")).alias("data_referencia"),
        "valor_despesa",
    )


def load_mart(staging: DataFrame, dtype=MONEY) -> DataFrame:
    """Staging mart text columns (positional) -> typed mart rows.

    ``dtype`` is the type of the amounts: totals of large ledgers need more
    digits than one amount."""
    c = staging.columns
    return staging.select(
        digits_key(F.col(c[0]), "bigint").alias("registro_ans"),
        F.col(c[1]).alias("cnpj"),
        F.col(c[2]).alias("razao_social"),
        F.left(F.col(c[3]), F.lit(2)).alias("uf"),
        comma_decimal(F.col(c[4]), dtype).alias("valor_total"),
        comma_decimal(F.col(c[5]), dtype).alias("media_trimestral"),
        comma_decimal(F.col(c[6]), dtype).alias("desvio_padrao"),
    )
