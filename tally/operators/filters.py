"""Filters and predicates (F1-F7). Plain Column predicates so Catalyst can push
them into the parquet scan where the column is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ci_contains, digits_only


def account_prefix(df: DataFrame, column: str = "Conta", prefix: str = "4") -> DataFrame:
    """Keep ledger accounts starting with ``prefix`` (F1); no-op if the column is absent."""
    if column not in df.columns:
        return df
    return df.filter(F.col(column).cast("string").startswith(prefix))


def positive(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose value is > 0 (F2, F6). NULL is dropped."""
    return df.filter(F.col(column) > 0)


def search(df: DataFrame, term: str | None, columns=("razao_social", "cnpj"),
           literal: bool = False) -> DataFrame:
    """Case-insensitive substring search over several columns, OR-ed.

    NULL or empty ``term`` means no filter, as in the served listing.
    """
    if not term:
        return df
    cond = None
    for c in columns:
        p = ci_contains(F.col(c), term, literal)
        cond = p if cond is None else cond | p
    return df.filter(cond)


def normalised_key_equals(df: DataFrame, column: str, argument: str,
                          stored: str | None = None) -> DataFrame:
    """Rows whose digits-only ``column`` equals the digits of ``argument``.

    An argument without digits matches nothing (decision D15). When the
    table stores the normalised key (``stored``, e.g. ``cnpj_digits``) the
    test is a plain equality on it, which reaches the parquet scan as a
    pushed filter; otherwise the digits are extracted row by row.
    """
    arg = "".join(ch for ch in argument if "0" <= ch <= "9") if argument else ""
    if not arg:
        return df.limit(0)
    if stored and stored in df.columns:
        return df.filter(F.col(stored) == F.lit(arg))
    return df.filter(digits_only(F.col(column)) == F.lit(arg))


def keep_rows(df: DataFrame, cond) -> DataFrame:
    """Keep rows satisfying ``cond(row)`` without recomputing derived columns.

    A plain ``filter`` on a column computed in the same plan (a regex
    extraction, a parsed number) is pushed by the optimizer below the
    projection that defines it, with the column's expression copied into the
    filter, so the expensive expression runs twice per row. Emitting the kept
    rows through a generator (``inline`` of a filtered one-element array)
    keeps the test above the projection: each row is computed once.
    ``cond`` receives the row as a struct column: ``lambda r: r["v"] > 0``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    kept = F.filter(F.array(row), lambda r: F.coalesce(cond(r), F.lit(False)))
    return df.select(F.inline(kept))
