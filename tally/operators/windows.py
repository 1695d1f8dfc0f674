"""First / last value per key and growth.

The reference takes ``FIRST_VALUE`` over a window ordered by date, twice, and
then de-duplicates. Here both ends come from two hash aggregates: the
smallest value per (key, date), then ``min_by`` / ``max_by`` over dates that
are now unique per key. Both levels are partial-aggregated in every map task
with fixed-width buffers (``HashAggregate``, no sort of the rows, unlike a
struct ordering key which forces ``SortAggregate``), and a key that holds a
third of all rows is reduced to one row per date inside each task.

Ties on the date (many ledger rows of one quarter, decision D9) are broken by
the value, smallest first at both ends, which makes the answer deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio


def first_last(
    df: DataFrame,
    key: str,
    order_col: str,
    value: str,
    first_alias: str = "valor_inicial",
    last_alias: str = "valor_final",
) -> DataFrame:
    """Value at the earliest and at the latest ``order_col`` per key."""
    per_point = df.groupBy(key, order_col).agg(F.min(value).alias("_v"))
    return per_point.groupBy(key).agg(
        F.min_by("_v", order_col).alias(first_alias),
        F.max_by("_v", order_col).alias(last_alias),
    )


def growth_pct(initial: Column, final: Column, scale: int = 2) -> Column:
    """``round((final - initial) / nullif(initial, 0) * 100, 2)``.

    Exact decimal arithmetic, HALF_UP; a zero start gives NULL.
    """
    return F.round(safe_ratio(final - initial, initial) * F.lit(100), scale)
