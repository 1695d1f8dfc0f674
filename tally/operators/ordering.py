"""Sort, top-k and paging.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
only its local top k, so the shuffle carries k rows per task, not the data.
Every ordering here ends on a unique column so ties cannot reorder results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def ranked(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Full sort (T1). Use only at the final sink: it range-partitions all rows."""
    return df.orderBy(*_cols(order))


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows under ``order``."""
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*_cols(order)).limit(k)


def page(df: DataFrame, order: Sequence[Column | str], page_no: int = 1,
         limit: int = 10) -> DataFrame:
    """Offset paging ``ORDER BY .. LIMIT l OFFSET (p-1)*l``.

    Page and limit below 1 are rejected (the served endpoint did not check).
    Each task keeps ``offset + limit`` rows, so deep pages cost more.
    """
    if page_no < 1 or limit < 1:
        raise ValueError("page and limit must be >= 1")
    return df.orderBy(*_cols(order)).offset((page_no - 1) * limit).limit(limit)


def page_after(df: DataFrame, key: str, after=None, limit: int = 10) -> DataFrame:
    """Keyset paging: the ``limit`` rows whose unique ``key`` follows ``after`` (T3 variant).

    ``key > after`` is a plain comparison on a stored column, so it reaches
    the parquet scan and row groups below ``after`` are skipped; the cost of
    a page does not grow with its depth, unlike an offset.
    """
    if limit < 1:
        raise ValueError("limit must be >= 1")
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rows.orderBy(F.col(key).asc()).limit(limit)


def desc(name: str) -> Column:
    """Descending, NULLs last (decision D21: always spelled out)."""
    return F.col(name).desc_nulls_last()


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()
