"""Joins (J1-J6).

Broadcast policy:

* a stored dimension is broadcast only after a *bounded* size check that
  measures its row count and byte size (reads at most n+1 rows per
  partition of a scan), otherwise the join is left to a shuffle join;
* a side that only exists after an aggregation is not counted eagerly (that
  would run the aggregation twice); AQE measures it after its shuffle and
  switches to a broadcast when it is small, or keeps the shuffle join and
  splits skewed partitions;
* sides that are small by construction (one row per period, fixed reference
  tables) are hinted directly, with the reason where they are hinted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_key, unknown_operator_label

# Largest side we broadcast: at most this many rows and this many bytes of
# column text (measured, not assumed), well under executor memory.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
         max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows whose text rendering
    totals at most ``max_bytes`` bytes.

    One bounded job over at most ``max_rows + 1`` rows per partition: the
    row count and the summed byte length of every column rendered as text
    (plus 8 bytes per value), an upper-side estimate of the hashed relation.
    """
    width = None
    for c in df.columns:
        w = F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(8)
        width = w if width is None else width + w
    probe = df.limit(max_rows + 1)
    row = probe.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(width if width is not None else F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only behind the measured size check; else the plain side."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Fact-to-dimension equi-join (J3, J4); the dimension is the build side."""
    return fact.join(maybe_broadcast(dim, max_rows), on, how)


def left_enrich(
    ledger: DataFrame,
    registry: DataFrame,
    key: str = "RegistroANS",
    null_safe: bool = False,
    max_rows: int = BROADCAST_MAX_ROWS,
    check_size: bool = True,
) -> DataFrame:
    """Left enrichment join (J1) on cleaned text keys (J2), then label fill.

    ``check_size=True`` probes a stored registry and broadcasts it when it is
    within the bound; pass ``False`` for a registry that is itself derived
    (e.g. de-duplicated), leaving the choice to the planner's size estimate
    and AQE instead of running its aggregation an extra time.

    ``registry`` must already be unique per key (see ``sets.keep_first``), so
    the join cannot multiply ledger rows. Keys are compared after cleaning
    both sides; a NULL key never matches unless ``null_safe=True``.
    Unmatched rows get ``CNPJ='N/A'``, ``UF='N/A'`` and a per-row
    ``Operadora <key> Desconhecida`` name (decision D3).
    """
    led = ledger.withColumn(key, clean_key(F.col(key).cast("string")))
    reg_cols = [c for c in registry.columns if c != key]
    # ledger columns that collide with registry ones are dropped (registry wins)
    led = led.drop(*[c for c in reg_cols if c in led.columns])
    reg = registry.withColumn(key, clean_key(F.col(key).cast("string")))
    if check_size:
        reg = maybe_broadcast(reg, max_rows)
    if null_safe:
        joined = led.join(reg, led[key].eqNullSafe(reg[key]), "left").drop(reg[key])
    else:
        joined = led.join(reg, key, "left")
    out = joined
    if "CNPJ" in reg_cols:
        out = out.withColumn("CNPJ", F.coalesce("CNPJ", F.lit("N/A")))
    if "RazaoSocial" in reg_cols:
        out = out.withColumn(
            "RazaoSocial", F.coalesce("RazaoSocial", unknown_operator_label(F.col(key)))
        )
    if "UF" in reg_cols:
        out = out.withColumn("UF", F.coalesce("UF", F.lit("N/A")))
    return out


def join_group_stats(
    detail: DataFrame, stats: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Detail rows joined to their own group's aggregate.

    ``stats`` must be one row per group; the caller guarantees that the
    number of groups is small by construction (e.g. periods), so it is the
    broadcast side and the detail side is never shuffled.
    """
    return detail.join(F.broadcast(stats), list(keys), "inner")
