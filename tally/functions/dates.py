"""Period helpers (ops C8, C12, S4, H5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The period patterns of the ledger folders: a four-digit year
# anywhere in the year link, and "<digit>T" (any case) in the quarter link.
YEAR_PATTERN = r"(\d{4})"
QUARTER_PATTERN = r"(?i)(\d)T"


def quarter_start(year: Column, quarter: Column) -> Column:
    """First day of the quarter: ``make_date(y, (q-1)*3+1, 1)``."""
    return F.make_date(year, (quarter - F.lit(1)) * F.lit(3) + F.lit(1), F.lit(1))


def year_from_text(text: Column) -> Column:
    """First four-digit run as int; NULL when absent."""
    return F.nullif(F.regexp_extract(text, YEAR_PATTERN, 1), F.lit("")).cast("int")


def quarter_from_text(text: Column) -> Column:
    """Digit before the first ``T``/``t`` as int; NULL when absent."""
    return F.nullif(F.regexp_extract(text, QUARTER_PATTERN, 1), F.lit("")).cast("int")


def date_text(d: Column) -> Column:
    """Date rendered as ``yyyy-MM-dd`` text at the serving edge (C11)."""
    return F.date_format(d, "yyyy-MM-dd")
