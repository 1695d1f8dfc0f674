"""Aggregations (A1-A10).

Every aggregate here is decomposable (sum, count, min/max, variance
moments), so Catalyst plans a partial aggregate inside each map task and
shuffles only one row per key per task: a key that holds a third of all rows
costs no more in the shuffle than any other key. Money stays decimal; sums
widen exactly (``decimal(15,2)`` -> ``decimal(25,2)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_ratio


def operator_profile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    names=("ValorTotal", "MediaTrimestral", "DesvioPadrao", "QtdRegistros"),
) -> DataFrame:
    """Per-group sum, mean, sample standard deviation and row count (A1, A2).

    Rows with a NULL group key are left out (decision D4). The standard
    deviation of a one-row group is 0, not NULL (A2). The mean is over rows
    (decision D11).
    """
    total, mean, std, cnt = names
    v = F.col(value)
    grouped = df.filter(F.lit(True) if not keys else _all_not_null(keys)).groupBy(*keys)
    return grouped.agg(
        F.sum(v).alias(total),
        F.avg(v).alias(mean),
        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias(std),
        F.count(v).alias(cnt),
    )


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        p = F.col(k).isNotNull()
        cond = p if cond is None else cond & p
    return cond


def per_member_mean(total: Column, members: Column, scale: int = 2) -> Column:
    """``round(sum / count(distinct member), 2)`` (A4), exact decimal HALF_UP."""
    return F.round(safe_ratio(total, members.cast("decimal(20,0)")), scale)


def period_stats(fact: DataFrame, period=("ano", "trimestre"), value="valor_despesa") -> DataFrame:
    """Per-period sum and row count (A5).

    The mean itself is ``sum / n``; it is kept as the pair so that comparisons
    against it stay exact (decision D20: ``v * n > sum`` instead of ``v > avg``).
    """
    return fact.groupBy(*period).agg(
        F.sum(value).alias("period_sum"), F.count(F.lit(1)).alias("period_rows")
    )


def period_mean(fact: DataFrame, period=("ano", "trimestre"), value="valor_despesa",
                scale: int = 2) -> DataFrame:
    """Mean value per period, rounded exactly (A5)."""
    st = period_stats(fact, period, value)
    return st.select(
        *period, "period_sum", "period_rows",
        F.round(st.period_sum / st.period_rows.cast("decimal(20,0)"), scale).alias("media_geral"),
    )


def global_total(fact: DataFrame, value="valor_despesa", alias="total_despesas") -> DataFrame:
    """Whole-table sum; an empty table gives 0."""
    return fact.agg(F.coalesce(F.sum(value), F.lit(0).cast("decimal(25,2)")).alias(alias))


def mean_of_totals(fact: DataFrame, key="registro_ans", value="valor_despesa",
                   alias="media_por_operadora", scale: int = 2) -> DataFrame:
    """Mean over keys of the per-key sum; empty gives 0.

    Two aggregation levels: a partial+final sum per key, then a global sum
    and count over the (much smaller) per-key table.
    """
    per_key = fact.groupBy(key).agg(F.sum(value).alias("_t"))
    out = per_key.agg(F.sum("_t").alias("_s"), F.count(F.lit(1)).alias("_n"))
    mean = F.round(safe_ratio(F.col("_s"), F.col("_n").cast("decimal(20,0)")), scale)
    return out.select(F.coalesce(mean, F.lit(0)).alias(alias))


def filtered_count(df: DataFrame, alias: str = "total") -> DataFrame:
    """``count(*)`` of an already filtered frame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def above_period_mean(
    fact: DataFrame,
    key: str = "registro_ans",
    period=("ano", "trimestre"),
    value: str = "valor_despesa",
) -> DataFrame:
    """Per key: ledger rows above their period mean, and distinct periods with
    at least one such row (A6a, A6b; decisions D10, D20).

    Plan: per-period (sum, n) is one row per period, so it is broadcast to the
    detail rows (J5) without shuffling them; the flag is exact decimal
    arithmetic ``v * n > sum``; then a two-level aggregate (per key-period,
    then per key) instead of a count-distinct, both partial-aggregated.
    """
    from .joins import join_group_stats

    stats = period_stats(fact, period, value)
    flagged = join_group_stats(fact.select(key, *period, value), stats, period)
    above = F.col(value) * F.col("period_rows").cast("decimal(20,0)") > F.col("period_sum")
    per_period = flagged.groupBy(key, *period).agg(
        F.sum(F.when(above, 1).otherwise(0)).alias("_rows_above")
    )
    return per_period.groupBy(key).agg(
        F.sum("_rows_above").cast("bigint").alias("rows_above"),
        F.count(F.when(F.col("_rows_above") > 0, 1)).alias("periods_above"),
    )
