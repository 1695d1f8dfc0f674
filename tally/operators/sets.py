"""Set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL aligned by column name; missing columns become NULL."""
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """SELECT DISTINCT (X3): partial aggregation before the shuffle."""
    return (df.select(*cols) if cols else df).distinct()


def _order_field(df: DataFrame, name: str, ascending: bool) -> list[Column]:
    """Fields of a struct whose natural order is (nulls last, name asc/desc)."""
    c = F.col(name)
    fields = [c.isNull()]  # false sorts before true: non-null rows first
    if ascending:
        fields.append(c)
        return fields
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        fields.append(-c)
    elif isinstance(dtype, (DateType, TimestampType)):
        fields.append(-F.unix_micros(c.cast("timestamp")))
    else:
        raise TypeError(f"descending order on {dtype} is not supported by keep_first")
    return fields


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | tuple[str, bool]],
) -> DataFrame:
    """One row per key: the first one under ``order`` (X2, decision D12).

    ``order`` lists columns (``name`` or ``(name, ascending)``), NULLs last.
    Give a total order (all columns) for a deterministic pick.

    Written as ``min(struct(order..., payload...))`` per key rather than
    ``row_number() over (partition by key)``: the aggregate reduces every key
    inside each map task before the shuffle, so a key holding a third of all
    rows never lands whole in one task, while the window would sort that key's
    rows in a single task.
    """
    keys = list(keys)
    spec = [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]
    fields: list[Column] = []
    for i, (name, asc) in enumerate(spec):
        for j, f in enumerate(_order_field(df, name, asc)):
            fields.append(f.alias(f"_o{i}_{j}"))
    payload = [c for c in df.columns if c not in keys]
    fields += [F.col(c).alias(c) for c in payload]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    return best.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    )
