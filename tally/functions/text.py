"""Text helpers (ops C4-C7, C10, J2, H1, S10). Column -> Column, native only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a default pandas CSV read turns into missing values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Header folding of the ledger files (three accented capitals).
FOLD_FROM = "ÇÃÕ"
FOLD_TO = "CAO"


def digits_only(text: Column) -> Column:
    """Remove every non-ASCII-digit character (C4). NULL stays NULL."""
    return F.regexp_replace(text, r"[^0-9]", "")


def digits_key(text: Column, dtype: str = "bigint") -> Column:
    """Digits only, empty -> NULL, then integer (C4). Overflow -> NULL."""
    return F.nullif(digits_only(text), F.lit("")).try_cast(dtype)


def clean_key(text: Column) -> Column:
    """Join-key cleaning (J2): strip surrounding blanks, drop one trailing ``.0``."""
    stripped = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.regexp_replace(stripped, r"\.0$", "")


def fold_accents(text: Column) -> Column:
    """Map the three accented capitals of ledger headers to ASCII."""
    return F.translate(text, FOLD_FROM, FOLD_TO)


def normalise_header_col(text: Column) -> Column:
    """Header normalisation as a Column (H1): strip, upper, fold, ' '->'_', drop '.'."""
    up = fold_accents(F.upper(F.trim(text)))
    return F.translate(F.replace(up, F.lit(" "), F.lit("_")), ".", "")


def normalise_header(name: str) -> str:
    """Same rule for a column name (names live on the driver, not in rows)."""
    out = name.strip().upper()
    for a, b in zip(FOLD_FROM, FOLD_TO):
        out = out.replace(a, b)
    return out.replace(" ", "_").replace(".", "")


def state_code(text: Column, missing: str = "N/A") -> Column:
    """State cleanup (C7, decision D5): ``left(nullif(uf, 'N/A'), 2)``."""
    return F.left(F.nullif(text, F.lit(missing)), F.lit(2))


def null_tokens(text: Column, tokens=NA_TOKENS) -> Column:
    """Turn any of the missing-value tokens into NULL."""
    return F.when(~text.isin(*tokens), text)


def ci_contains(text: Column, term: str, literal: bool = False) -> Column:
    """Case-insensitive ``ILIKE '%term%'``.

    As in the served search, ``%`` and ``_`` inside ``term`` are wildcards
    unless ``literal=True`` escapes them.
    """
    if literal:
        term = term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return text.ilike(f"%{term}%")


def unknown_operator_label(key: Column) -> Column:
    """Per-row label for an expense with no registry row (C10, decision D3)."""
    return F.concat(F.lit("Operadora "), key.cast("string"), F.lit(" Desconhecida"))
