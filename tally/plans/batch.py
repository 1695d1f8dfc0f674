"""End-to-end batch run: raw files -> consolidated ledger -> mart + warehouse.

Stage hand-offs are Parquet tables (types kept) instead of CSV. Each stage's
output is written to shared storage and read back before the next stage, so
a lost executor only recomputes the current stage, never the whole chain
(lineage is cut by the written table, not by ``localCheckpoint``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_key, digits_key
from ..operators.ordering import asc, desc, ranked
from ..operators.search_index import SearchIndex
from ..operators.quality import cnpj_audit, referential_audit
from ..operators.sets import union_all
from ..session import scratch_path
from ..sinks.snapshots import Snapshots
from ..sinks.tables import write_delimited, write_fact, write_lookup, write_table
from ..sources.archives import archive_errors, archive_records, parse_members, read_spreadsheets
from ..sources.delimited import period_from_path, read_layouts, read_tolerant
from ..sources.links import latest_periods, prune_to_periods
from .consolidate import LEDGER_COLUMNS, canonical_ledger, canonical_registry, checked_ledger
from .mart import enriched_ledger, operator_mart
from .warehouse import load_dimension, load_fact, load_mart


# what one refresh publishes together
TABLES = ("ledger", "registry", "mart", "mart_table", "dimension", "quarantine", "fact",
          "audit_cnpj", "audit_orphans", "audit_archives", "search/postings", "search/counts")
# a sum of money amounts
TOTAL = "decimal(25,2)"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (shared storage) and return the re-read table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def raw_frames(spark: SparkSession, group, formats: Sequence[str],
               scratch: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """All-text frames (with ``_source_path``) of one group: one per header
    and dialect of the loose delimited files, and one per member layout of the
    ZIP archives and of the spreadsheets found under it. The second list holds
    the unreadable archives and spreadsheets with their errors.

    Archive and sheet records are expanded once (Python work) and written to
    ``scratch``; headers and every layout are then read from that table
    instead of expanding the files again per layout.
    """
    frames: list[DataFrame] = []
    errors: list[DataFrame] = []
    if "csv" in formats:
        frames += read_layouts(spark, group)
    for fmt, expand in (("zip", archive_records), ("xlsx", read_spreadsheets)):
        if fmt in formats:
            records = materialize(expand(spark, group), f"{scratch}_{fmt}")
            frames += parse_members(records)
            errors.append(archive_errors(records))
    return frames, errors


def folder_periods(spark: SparkSession, groups: Sequence, path_pattern: str) -> DataFrame:
    """(ano, trimestre) of every file under the groups, from the folder names.

    A file listing only: the binary source does not read file contents when
    the content column is not selected.
    """
    paths = [g for group in groups for g in ([group] if isinstance(group, str) else group)]
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(paths).select(F.col("path").alias("_source_path")))
    found = period_from_path(listing, "_source_path", path_pattern)
    return found.filter(F.col("ano").isNotNull() & F.col("trimestre").isNotNull())


def folders_of(files: DataFrame, periods: Sequence) -> list[str]:
    """Folders that hold files of the chosen ``periods`` (ano, trimestre), as read paths.

    One row per folder reaches the driver. A folder inside another chosen one
    is left out, because folders are read with all that lies under them.
    """
    chosen = [(F.col("ano") == p["ano"]) & (F.col("trimestre") == p["trimestre"]) for p in periods]
    cond = F.lit(False)
    for c in chosen:
        cond = cond | c
    folder = F.regexp_replace("_source_path", "/[^/]*$", "")
    found = sorted(r[0] for r in files.filter(cond).select(folder).distinct().collect())
    tops: list[str] = []
    for f in found:
        if not any(f.startswith(t + "/") for t in tops):
            tops.append(f)
    # the reader takes paths as globs
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", t) for t in tops]


@dataclass
class Warehouse:
    ledger: DataFrame
    mart: DataFrame
    mart_table: DataFrame
    dimension: DataFrame
    quarantined: DataFrame
    fact: DataFrame
    cnpj_audit: DataFrame
    orphan_audit: DataFrame
    rejected_amounts: DataFrame
    archive_errors: DataFrame
    search_index: SearchIndex


def build_warehouse(
    spark: SparkSession,
    ledger_groups: Sequence[str | Sequence[str]],
    registry_path: str,
    registry_columns: Sequence[str] | None = None,
    out: str | None = None,
    path_pattern: str = r"(\d{4})_T(\d)",
    formats: Sequence[str] = ("csv", "zip", "xlsx"),
    latest_quarters: int | None = None,
) -> Warehouse:
    """Run R9, R10 and R11 over files and write every table as a new version
    under ``out`` (default: a folder in the shared ``spark.checkpoint.dir``),
    which becomes current as a whole when all of them are written (K3). Each group is
    searched for loose delimited files, ZIP archives and spreadsheets.
    ``latest_quarters=N`` ingests only the N latest quarters found in the
    folder names (S5), each quarter once however many files it has (D7), and
    opens only folders that hold files of those quarters.

    The ledger table is partitioned by ``rejected``: amounts beyond the money
    type lie in its ``rejected=true`` folder (``Warehouse.rejected_amounts``),
    and unreadable archives are listed in ``audit_archives``."""
    root = (out or scratch_path(spark, "warehouse")).rstrip("/")
    snapshots = Snapshots(spark, root)
    version = snapshots.begin()
    base = version.path
    periods = None
    if latest_quarters:
        chosen = latest_periods(folder_periods(spark, ledger_groups, path_pattern), latest_quarters)
        periods = spark.createDataFrame(chosen.collect(), "ano int, trimestre int")
    shaped, unread = [], []
    for i, group in enumerate(ledger_groups):
        if periods is not None:
            group = folders_of(folder_periods(spark, [group], path_pattern), periods.collect())
            if not group:
                continue
        frames, errors = raw_frames(spark, group, formats, f"{root}/staging/records_{i}")
        unread += errors
        for raw in frames:
            raw = period_from_path(raw, "_source_path", path_pattern).drop("_source_path")
            if periods is not None:  # a chosen folder may hold files of other quarters
                raw = prune_to_periods(raw, periods)
            shaped.append(canonical_ledger(raw, period_cols=("ano", "trimestre")))
    checked = checked_ledger(shaped)
    checked.write.mode("overwrite").partitionBy("rejected").parquet(f"{base}/ledger")
    stored = spark.read.schema(checked.schema).parquet(f"{base}/ledger")
    ledger = stored.filter(~F.col("rejected")).select(*LEDGER_COLUMNS)
    rejected = stored.filter("rejected").select("RegistroANS", "Ano", "Trimestre", "ValorTexto")
    no_errors = spark.createDataFrame([], "archive string, error string")
    write_table(union_all([no_errors, *unread]), f"{base}/audit_archives")

    cols = list(registry_columns) if registry_columns else None
    registry = canonical_registry(read_tolerant(spark, registry_path, cols))
    registry = materialize(registry, f"{base}/registry")

    mart = operator_mart(ledger, registry)
    write_table(mart, f"{base}/mart")
    stored_mart = spark.read.parquet(f"{base}/mart")
    # the served table, under its own column names and types
    write_table(load_mart(stored_mart.select([F.col(c).cast("string") for c in stored_mart.columns]),
                          TOTAL), f"{base}/mart_table")

    dim, bad = load_dimension(registry)
    write_lookup(dim, f"{base}/dimension", ["cnpj_digits", "registro_ans"])
    dim = spark.read.parquet(f"{base}/dimension")
    index = SearchIndex.build(dim, f"{base}/search")
    write_table(bad, f"{base}/quarantine")
    staging = ledger.withColumn(
        "ValorDespesas", F.replace(F.col("ValorDespesas").cast("string"), F.lit("."), F.lit(",")))
    write_fact(load_fact(staging, dim), f"{base}/fact")
    fact = spark.read.parquet(f"{base}/fact")

    # audits (V2, V3): invalid tax ids with rows and value at stake, and
    # ledger rows whose operator is not in the registry (kept in the mart,
    # left out of the fact: decision D23). One row per key before the join.
    per_key = ledger.groupBy(clean_key(F.col("RegistroANS")).alias("RegistroANS")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("ValorDespesas").alias("_v"))
    write_table(cnpj_audit(enriched_ledger(per_key, registry), "CNPJ", "RegistroANS", "_v", rows="_n"),
                f"{base}/audit_cnpj")
    ledger_keys = ledger.select(
        digits_key(F.col("RegistroANS")).alias("registro_ans"),
        F.col("ValorDespesas").alias("valor_despesa"))
    write_table(referential_audit(ledger_keys, dim), f"{base}/audit_orphans")
    snapshots.commit(version, TABLES)
    # the exported artifact: ';' text, header, 2-decimal numbers, gzip (K1, K2),
    # sorted in the export itself, as a re-read table keeps no order
    write_delimited(ranked(stored_mart, [desc("ValorTotal"), asc("RegistroANS")]),
                    f"{root}/mart_csv", compression="gzip")
    return Warehouse(
        ledger=ledger,
        mart=stored_mart,
        mart_table=spark.read.parquet(f"{base}/mart_table"),
        dimension=dim,
        quarantined=spark.read.parquet(f"{base}/quarantine"),
        fact=fact,
        cnpj_audit=spark.read.parquet(f"{base}/audit_cnpj"),
        orphan_audit=spark.read.parquet(f"{base}/audit_orphans"),
        rejected_amounts=rejected,
        archive_errors=spark.read.parquet(f"{base}/audit_archives"),
        search_index=index,
    )
