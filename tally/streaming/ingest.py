"""Incremental ledger ingest with Structured Streaming.

The reference consolidates quarterly files in one batch run. Data arrives a
quarter at a time, so the same consolidation (R9) is also offered as a file
stream: new delimited files landing in a folder are shaped into canonical
ledger rows and appended to the period-partitioned table. The stream's
checkpoint lives under the shared ``spark.checkpoint.dir``, so a restarted
driver or lost executors resume from the last committed batch. Each
micro-batch writes under its own ``batch_id=<id>`` folder inside the period
folders with dynamic partition overwrite, so a replayed batch replaces
exactly its own files (idempotent) and never touches rows that an earlier
batch wrote for the same quarter.

What a batch cannot take is written beside the target by batch: amounts beyond
the money type (``rejected_path``) and unreadable archives (``errors_path``).

There is no event-time logic here (the reference has none): no watermark or
state store is needed, only exactly-once file tracking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.consolidate import LEDGER_COLUMNS, LEDGER_TYPES, canonical_ledger, checked_ledger
from ..session import scratch_path
from ..sources.delimited import period_from_path


def ledger_stream(spark: SparkSession, landing: str, columns: Sequence[str],
                  sep: str = ";", encoding: str = "ISO-8859-1",
                  max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming all-text scan of the landing folder (file source needs a schema)."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    raw = (spark.readStream.schema(schema).option("header", "true").option("sep", sep)
           .option("encoding", encoding).option("escape", '"').option("maxFilesPerTrigger", max_files_per_trigger)
           .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[cC][sS][vV]")
           .csv(landing))
    return raw.withColumn("_source_path", F.col("_metadata.file_path"))


def checked_batch(raw: DataFrame, path_pattern: str = r"(\d{4})_T(\d)") -> DataFrame:
    """Canonical rows of one micro-batch (same rules as R9), with the amounts that the ledger cannot hold marked."""
    with_period = period_from_path(raw, "_source_path", path_pattern)
    shaped = canonical_ledger(with_period.drop("_source_path"), period_cols=("ano", "trimestre"))
    if shaped is None:
        # no value column (H3): no rows, with the types of the ledger
        none = {**{c: LEDGER_TYPES[c] for c in LEDGER_COLUMNS}, "ValorTexto": "string", "rejected": "boolean"}
        return with_period.limit(0).select(*[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    return checked_ledger([shaped])


def shape_batch(raw: DataFrame, path_pattern: str = r"(\d{4})_T(\d)") -> DataFrame:
    """Canonical ledger rows of one micro-batch (same rules as R9)."""
    return checked_batch(raw, path_pattern).filter(~F.col("rejected")).select(*LEDGER_COLUMNS)


def rejected_path(target: str) -> str:
    """Where the amounts beyond the money type go, as written, by batch."""
    return target.rstrip("/") + "_rejected"


def errors_path(target: str) -> str:
    """Where the archives that could not be read go, with the error, by batch."""
    return target.rstrip("/") + "_errors"


def _write_checked(checked: DataFrame, target: str, staging: str, epoch_id: int) -> None:
    """One pass over the batch's files, then the ledger rows and the rejected amounts from what it wrote.

    Every folder holds the batch id, so a batch that runs again replaces its own rows.
    """
    spark = checked.sparkSession
    path = f"{staging}/batch_id={epoch_id}"
    checked.write.mode("overwrite").partitionBy("rejected").parquet(path)
    stored = spark.read.schema(checked.schema).parquet(path)
    rows = stored.filter(~F.col("rejected")).select(*LEDGER_COLUMNS).withColumn("batch_id", F.lit(epoch_id))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("Ano", "Trimestre", "batch_id").parquet(target))
    bad = stored.filter("rejected").select("RegistroANS", "Ano", "Trimestre", "ValorTexto")
    bad.write.mode("overwrite").parquet(f"{rejected_path(target)}/batch_id={epoch_id}")


def start_ingest(spark: SparkSession, landing: str, target: str, columns: Sequence[str],
                 name: str = "ledger_ingest", available_now: bool = True,
                 sep: str = ";", encoding: str = "ISO-8859-1") -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    stream = ledger_stream(spark, landing, columns, sep, encoding)
    staging = scratch_path(spark, f"streams/{name}_checked")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        _write_checked(checked_batch(batch), target, staging, epoch_id)

    w = (stream.writeStream.queryName(name).foreachBatch(write_batch)
         .option("checkpointLocation", scratch_path(spark, f"streams/{name}")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_archive_ingest(spark: SparkSession, landing: str, target: str,
                         name: str = "archive_ingest", available_now: bool = True,
                         path_pattern: str = r"(\d{4})_T(\d)",
                         max_files_per_trigger: int = 10) -> StreamingQuery:
    """Stream newly landed quarterly ZIP archives into the ledger table.

    A ``binaryFile`` file stream hands each micro-batch of new archives to
    the same record reader as the batch path (``mapInPandas`` over
    ``zipfile`` + ``csv``); the batch's records are written once under the
    checkpoint folder, every member layout is parsed from that table, and
    the canonical rows go to the period/batch folders as in
    :func:`start_ingest`.
    """
    from ..sources.archives import RECORDS_SCHEMA, _expand, archive_errors, parse_members
    from ..sources.delimited import SKIP_NAME_PARTS

    # the binary source's fixed schema (streams must declare theirs)
    binary = ("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    stream = (spark.readStream.format("binaryFile").schema(binary)
              .option("pathGlobFilter", "*.[zZ][iI][pP]")
              .option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing))
    staging = scratch_path(spark, f"streams/{name}_records")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        records = batch.select("path", "content").mapInPandas(
            lambda it: _expand(it, (".csv",), SKIP_NAME_PARTS), RECORDS_SCHEMA)
        path = f"{staging}/batch_id={epoch_id}"
        records.write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        archive_errors(stored).write.mode("overwrite").parquet(f"{errors_path(target)}/batch_id={epoch_id}")
        frames = parse_members(stored)
        shaped = []
        for raw in frames:
            raw = period_from_path(raw, "_source_path", path_pattern).drop("_source_path")
            part = canonical_ledger(raw, period_cols=("ano", "trimestre"))
            if part is not None:
                shaped.append(part)
        if not shaped:
            return
        _write_checked(checked_ledger(shaped), target, f"{staging}_checked", epoch_id)

    w = (stream.writeStream.queryName(name).foreachBatch(write_batch)
         .option("checkpointLocation", scratch_path(spark, f"streams/{name}")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
