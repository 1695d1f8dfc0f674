"""Sinks (K1-K4).

* K1/K2: delimited text with header; optional gzip instead of a driver-side
  ZIP of a single file.
* K3: full refresh (overwrite) or dynamic overwrite of only the periods
  present in the new data, so re-running a load is idempotent.
* K4: the fact laid out by period folders and sorted by operator inside
  each file, so period filters prune folders and key lookups skip row groups;
  Bloom filters on the lookup keys (F5) of the fact and the dimension.
* The commit of several tables as one is in :mod:`tally.sinks.snapshots`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True,
                    compression: str | None = None, encoding: str = "UTF-8",
                    mode: str = "overwrite", float_places: int | None = 2) -> None:
    """Delimited text sink (K1, K2).

    Decimals print with their scale (money: 2 places); floating columns are
    rendered with ``float_places`` decimals (``None`` keeps Spark's default).
    """
    if float_places is not None:
        fmt = f"%.{float_places}f"
        df = df.select(*[
            F.when(F.col(f.name).isNotNull(), F.format_string(fmt, F.col(f.name))).alias(f.name)
            if isinstance(f.dataType, (FloatType, DoubleType)) else F.col(f.name)
            for f in df.schema.fields
        ])
    w = df.write.mode(mode).option("sep", sep).option("header", header).option("encoding", encoding).option("escape", '"')
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


# Row groups of looked-up tables: small enough that skipping one saves work, large enough to scan.
LOOKUP_ROW_GROUP = 32 << 20


def with_index(writer, keys: Sequence[str], distinct: int | None = None, row_group_bytes: int | None = None):
    """Bloom filters on ``keys`` for a Parquet writer (K4): an equality on a key
    skips every row group that cannot hold it, also where the group's least
    and largest key enclose it. ``distinct``: keys a row group has, if known."""
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        if distinct:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{k}", str(distinct))
        else:
            writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{k}", "true")
    return writer.option("parquet.block.size", str(row_group_bytes)) if row_group_bytes else writer


def write_fact(fact: DataFrame, path: str, partitions: int | None = None,
               period=("ano", "trimestre"), key: str = "registro_ans",
               mode: str = "overwrite", dynamic: bool = False,
               max_records_per_file: int = 5_000_000, row_group_bytes: int | None = LOOKUP_ROW_GROUP) -> None:
    """Period-partitioned, key-sorted fact table (K3, K4).

    Range partitioning on (period, key, row hash) spreads every period over
    many tasks, and the row hash lets the range partitioner split a key that
    holds a large share of the rows, so no single task writes a hot
    operator's whole history. ``dynamic=True`` replaces only the periods
    present in ``fact``. Row groups have a Bloom filter on the key, so the
    history of one operator reads the groups that hold it.
    """
    spark = fact.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[F.col(c) for c in fact.columns])
    laid = (
        fact.repartitionByRange(n, *[F.col(p) for p in period], F.col(key), spread)
        .sortWithinPartitions(*period, key)
    )
    w = laid.write.mode(mode).partitionBy(*period).option("maxRecordsPerFile", max_records_per_file)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    with_index(w, [key], row_group_bytes=row_group_bytes).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain parquet table (dimension, mart): full refresh by default (K3)."""
    df.write.mode(mode).parquet(path)


def write_lookup(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None,
                 mode: str = "overwrite", row_group_bytes: int | None = LOOKUP_ROW_GROUP) -> None:
    """A table that is looked up by any of ``keys`` (F5, K4): ranges of the first
    one lie together, and all have Bloom filters."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    with_index(laid.write.mode(mode), keys, row_group_bytes=row_group_bytes).parquet(path)
