"""Ledger consolidation (R9): raw quarterly files -> one canonical ledger.

Per file group (one layout): normalise headers (H1), map aliases to the
canonical names (H2), gate on the value column (H3), default what is missing
(H4), keep expense accounts (F1), parse the pt-BR amount (C1) and take the
period from the folder (H5). Groups are unioned by name (X1), the name
placeholders are set and non-positive amounts dropped (F2).

Everything is one lazy plan; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import MONEY, parse_number
from ..functions.text import normalise_header
from ..operators.filters import account_prefix, keep_rows
from ..operators.sets import union_all

# Ledger header aliases (after normalisation), tried in order.
LEDGER_ALIASES = {
    "ValorDespesas": ("VL_SALDO_FINAL", "VALOR"),
    "RegistroANS": ("REG_ANS", "REGISTRO_ANS", "CD_OPS"),
    "Conta": ("CD_CONTA_CONTABIL",),
    "CNPJ": ("CNPJ",),
    "RazaoSocial": ("RAZAO_SOCIAL", "RAZAO"),
}

# Registry header aliases (registry headers are only stripped
# and upper-cased before matching).
REGISTRY_ALIASES = {
    "RegistroANS": ("REGISTRO_OPERADORA", "REGISTRO_ANS", "REG_ANS", "CD_OPS", "CODIGO"),
    "CNPJ": ("CNPJ",),
    "RazaoSocial": ("RAZAO_SOCIAL",),
    "Modalidade": ("MODALIDADE",),
    "UF": ("UF",),
}

# Defaults for missing ledger columns and the final layout.
LEDGER_DEFAULTS = {"RegistroANS": "0", "CNPJ": "N/A", "RazaoSocial": "N/A"}
LEDGER_COLUMNS = ("RegistroANS", "CNPJ", "RazaoSocial", "Ano", "Trimestre", "ValorDespesas")
LEDGER_TYPES = {"RegistroANS": "string", "CNPJ": "string", "RazaoSocial": "string",
                "Ano": "int", "Trimestre": "int", "ValorDespesas": MONEY}
REGISTRY_COLUMNS = ("RegistroANS", "CNPJ", "RazaoSocial", "Modalidade", "UF")


class MissingColumn(ValueError):
    """A required column is absent (value column of a ledger, key of a registry)."""


def canonical_columns(df: DataFrame, aliases: dict[str, Sequence[str]],
                      normalise=normalise_header, keep: Sequence[str] = ()) -> dict:
    """Map canonical name -> Column, coalescing several hits in alias order."""
    by_norm: dict[str, str] = {}
    for c in df.columns:
        if c in keep:
            continue
        by_norm.setdefault(normalise(c), c)
    out = {}
    for canon, names in aliases.items():
        hits = [F.col(f"`{by_norm[n]}`") for n in names if n in by_norm]
        if hits:
            out[canon] = hits[0] if len(hits) == 1 else F.coalesce(*hits)
    return out


def canonical_ledger(raw: DataFrame, ano=None, trimestre=None,
                     period_cols: tuple[str, str] | None = None,
                     locale: str = "br") -> DataFrame | None:
    """One raw file group -> canonical rows, or ``None`` when it has no value column.

    The period comes from the folder: literal ``ano``/``trimestre`` or two
    existing columns (partition discovery) named in ``period_cols``.
    """
    keep = tuple(period_cols or ())
    cols = canonical_columns(raw, LEDGER_ALIASES, keep=keep)
    if "ValorDespesas" not in cols:
        return None  # H3: file skipped
    if period_cols:
        a, t = F.col(period_cols[0]).cast("int"), F.col(period_cols[1]).cast("int")
    else:
        a, t = F.lit(ano).cast("int"), F.lit(trimestre).cast("int")
    proj = {
        "RegistroANS": cols.get("RegistroANS", F.lit(LEDGER_DEFAULTS["RegistroANS"])),
        "CNPJ": cols.get("CNPJ", F.lit(LEDGER_DEFAULTS["CNPJ"])),
        "RazaoSocial": cols.get("RazaoSocial", F.lit(LEDGER_DEFAULTS["RazaoSocial"])),
        "Ano": a,
        "Trimestre": t,
        "ValorTexto": cols["ValorDespesas"],
    }
    if "Conta" in cols:
        proj["Conta"] = cols["Conta"]
    shaped = raw.select(*[c.alias(n) for n, c in proj.items()])
    shaped = account_prefix(shaped, "Conta", "4")  # F1 only if the column exists
    return shaped.select(
        "RegistroANS", "CNPJ", "RazaoSocial", "Ano", "Trimestre",
        parse_number(F.col("ValorTexto"), locale).alias("ValorDespesas"), "ValorTexto",
    )


def _placeholders(groups: Sequence[DataFrame | None]) -> DataFrame:
    """The canonical groups as one table, with the name placeholders set."""
    usable = [g for g in groups if g is not None]
    if not usable:
        raise MissingColumn("no ledger file with a value column")
    ledger = union_all(usable)
    return ledger.withColumns({"CNPJ": F.lit("N/A"), "RazaoSocial": F.lit("N/A")})


def consolidate(groups: Sequence[DataFrame | None]) -> DataFrame:
    """Union the canonical groups and finish the ledger.

    Raises :class:`MissingColumn` when no group had a value column.
    """
    ledger = _placeholders(groups)
    # F2 on the parsed amount: keep_rows, so the parse is not repeated inside
    # a pushed-down filter (``positive`` is the form for stored columns)
    return keep_rows(ledger.select(*LEDGER_COLUMNS), lambda r: r["ValorDespesas"] > 0)


def checked_ledger(groups: Sequence[DataFrame | None]) -> DataFrame:
    """The ledger rows of :func:`consolidate` plus the amounts that it cannot hold.

    ``rejected`` marks a positive amount beyond the money type; such a row has
    a NULL ``ValorDespesas`` and its amount as written in ``ValorTexto``,
    which is NULL in every other row. Partitioning the written table by
    ``rejected`` separates both in one pass over the files.
    """
    rows = _placeholders(groups).select(
        *LEDGER_COLUMNS, "ValorTexto",
        (F.col("ValorDespesas").isNull() & ~F.trim("ValorTexto").startswith("-")).alias("rejected"))
    kept = keep_rows(rows, lambda r: r["rejected"] | (r["ValorDespesas"] > 0))
    return kept.withColumn("ValorTexto", F.when(F.col("rejected"), F.col("ValorTexto")))


def canonical_registry(raw: DataFrame) -> DataFrame:
    """Registry text -> ``RegistroANS, CNPJ, RazaoSocial, Modalidade, UF`` (H2, H3).

    A missing key column is fatal; other missing columns are NULL.
    """
    cols = canonical_columns(raw, REGISTRY_ALIASES, normalise=lambda c: c.strip().upper())
    if "RegistroANS" not in cols:
        raise MissingColumn("registry has no operator key column")
    return raw.select(*[
        (cols[n] if n in cols else F.lit(None).cast("string")).alias(n) for n in REGISTRY_COLUMNS
    ])


__all__ = [
    "LEDGER_ALIASES", "REGISTRY_ALIASES", "MissingColumn", "canonical_ledger",
    "canonical_registry", "checked_ledger", "consolidate", "MONEY",
]
