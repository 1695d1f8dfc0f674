"""Number parsing from ledger text (ops C1, C2, C3).

All functions are Column -> Column and stay inside whole-stage codegen:
string replace, an ``rlike`` guard and ``try_cast``; no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(15, 2)

# What the ledger's numeric coercion accepts. Plain decimal or
# scientific text with optional sign and surrounding blanks. Suffixes such as
# "12d" or "1.5f", "inf"/"nan", hex and "1_0" are rejected on purpose
# (try_cast alone would accept some of them).
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_number(text: Column, locale: str = "br", dtype=MONEY, default=0) -> Column:
    """Text to number; text that is no number becomes ``default``.

    A number too large for ``dtype`` gives NULL, never the default: a valid
    amount must not turn into 0 (``consolidate.checked_ledger`` reports it).

    ``locale='br'`` first removes every ``.`` and then turns ``,`` into ``.``
    (so a plain ``1234.56`` reads as ``123456``, as the source ledger does).
    ``locale='plain'`` parses the text as is. Values are exact decimals
    (HALF_UP to the scale of ``dtype``), never binary floats.
    """
    if locale == "br":
        # one pass: '.' has no partner so it is deleted, ',' maps to '.'
        norm = F.translate(text, ",.", ".")
    elif locale == "plain":
        norm = text
    else:
        raise ValueError(f"unknown locale {locale!r}")
    value = F.when(norm.rlike(NUMERIC_TEXT), F.trim(norm).try_cast(dtype))
    return value if default is None else value.otherwise(F.lit(default).cast(dtype))


def comma_decimal(text: Column, dtype=MONEY, strict: bool = False) -> Column:
    """``replace(',', '.')`` then cast to decimal.

    ``strict=True`` uses an ANSI cast: malformed text or overflow raises, like
    the warehouse load does. Otherwise malformed text gives NULL.
    """
    norm = F.replace(text, F.lit(","), F.lit("."))
    return norm.cast(dtype) if strict else norm.try_cast(dtype)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return num / F.nullif(den, F.lit(0))
