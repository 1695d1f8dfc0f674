"""Data-quality operators (V1-V5): flag and report, never silently drop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.taxid import cnpj_is_valid
from .sets import duplicate_keys


def cnpj_audit(
    df: DataFrame,
    cnpj: str = "cnpj",
    key: str = "registro_ans",
    value: str = "valor_despesa",
    rows: str | None = None,
) -> DataFrame:
    """Invalid or missing tax ids with rows and value at stake (V2).

    Aggregates first (partial aggregation shrinks each map task to one row
    per id), then evaluates the check once per id instead of once per row.
    ``rows`` names a column of partial row counts when ``df`` is already
    pre-aggregated (their sum is the row count); otherwise rows are counted.
    """
    n = F.sum(rows) if rows else F.count(F.lit(1))
    per_id = df.groupBy(cnpj, key).agg(
        n.cast("bigint").alias("qtd_registros"), F.sum(value).alias("valor_total")
    )
    return per_id.filter(~cnpj_is_valid(cnpj))


def referential_audit(
    fact: DataFrame, dim: DataFrame, key: str = "registro_ans", value: str = "valor_despesa"
) -> DataFrame:
    """Rows and value of fact rows with no dimension row (V3, J6). One row."""
    # one row per key before the join, so a hot key costs one row per task
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
    orphans = per_key.join(dim.select(key), key, "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.coalesce(F.sum("_v"), F.lit(0)).cast("decimal(25,2)").alias("orphan_value"),
    )


def with_reason(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows with a ``reason``: ``null_key``, ``duplicate_key`` or NULL (clean) (V4).

    Two scans: the keys alone for the counts, and the rows once. Duplicates are found with a partial-aggregated count
    per key, not a window, and joined back, so a hot key is never sorted in
    one task. The duplicate-key table exists only after its aggregation, so
    its size is checked at run time by AQE (broadcast when small, otherwise a
    shuffle join whose skewed partitions AQE splits) instead of by an eager
    count that would run the aggregation twice.
    """
    keys = list(keys)
    null_cond = None
    for k in keys:
        p = F.col(k).isNull()
        null_cond = p if null_cond is None else null_cond | p
    dups = duplicate_keys(df.filter(~null_cond), keys).select(*keys, F.lit(True).alias("_dup"))
    reason = F.when(null_cond, F.lit("null_key")).when(F.col("_dup"), F.lit("duplicate_key"))
    # NULL keys match nothing, so their rows pass the left join unmarked
    return df.join(dups, keys, "left").withColumn("reason", reason).drop("_dup").select(*df.columns, "reason")


def quarantine(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (clean, quarantined with their ``reason``) (V4).

    Both sides read the same plan; to use both, write :func:`with_reason`
    (partitioned by ``reason``) and read its folders instead.
    """
    marked = with_reason(df, keys)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def domain_violations(
    df: DataFrame,
    max_lengths: Mapping[str, int] | None = None,
    decimals: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Rows that break a column domain (V5), with one boolean per rule.

    ``max_lengths``: text columns and their maximum length (VARCHAR(n)).
    ``decimals``: columns that must fit ``decimal(p, s)``.
    """
    flags = []
    for c, n in (max_lengths or {}).items():
        flags.append((F.length(F.col(c)) > n).alias(f"{c}_too_long"))
    for c, (p, s) in (decimals or {}).items():
        flags.append(
            (F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()).alias(
                f"{c}_out_of_range"
            )
        )
    if not flags:
        return df.limit(0)
    out = df.select("*", *flags)
    any_bad = None
    names = [c for c in out.columns if c not in df.columns]
    for n in names:
        p = F.coalesce(F.col(n), F.lit(False))
        any_bad = p if any_bad is None else any_bad | p
    return out.filter(any_bad)
