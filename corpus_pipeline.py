"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's result to the shared checkpoint folder as Parquet and
reads it back as the next stage's documents. All stages but the last keep the
columns of ``documents``.

Defined results: null and empty texts fail the quality rules; a document that
loses all its lines stays as an empty text, of which near-dedup keeps one. Of
repeated rows, and of documents that are near copies, the one with the smallest
id stays; a null id counts as larger than every other. Very long texts are
taken whole by every stage. Other columns, whatever their names, are kept as
they are by all stages but the last, which has its own; ``n_chars`` follows the
text and must be there. An empty table gives an empty result at every stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tally.llm._common import read_table, staged  # noqa: E402
from tally.llm.bag_minhash import drop_near_duplicates  # noqa: E402
from tally.llm.decontaminate import decontaminate  # noqa: E402
from tally.llm.lexical_packing import lexical_packing  # noqa: E402
from tally.llm.line_dedup import line_dedup  # noqa: E402
from tally.llm.quality_divergence import learn_reference, quality_filter  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language's histograms."""
    return quality_filter(docs, learn_reference(docs))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; ``n_chars`` follows."""
    out = line_dedup(docs)
    text = F.when(F.col("text").isNotNull(), F.col("text_kept"))
    new = {"text": text, "n_chars": F.when(F.col("n_dropped") > 0, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return lexical_packing(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("packing", packing),
]

# Divergence, Poisson signatures and tokenizers are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
