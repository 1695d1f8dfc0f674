"""Helpers shared by the training-data operators: staged tables, row keys, sizes."""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

MAX_ID = (1 << 63) - 1


def give_back() -> None:
    """Return to the system what Arrow and malloc keep of freed memory.

    Spark keeps a Python worker for later tasks, beside those of the next
    stage; what its largest task has freed would count for all of them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def tidied(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``mapInArrow`` function ``task``, which gives its memory back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation of what lies
    before it) and gives the planner real sizes for its join choices.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def order_id(col: str = "doc_id") -> Column:
    """The id as a long to compare by; a null id counts as larger than every other."""
    return F.coalesce(F.col(col).cast("long"), F.lit(MAX_ID))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: one pass over one column, one number to the driver."""
    return int(docs.select(F.octet_length(text_or_empty(text_col)).alias("n")).agg(F.sum("n")).first()[0] or 0)


def parts_for(n_bytes: int, bytes_per_part: int, least: int = 8) -> int:
    """How many pieces of about ``bytes_per_part`` the data makes; grows with the data, no upper bound."""
    return max(least, math.ceil(n_bytes / bytes_per_part))
