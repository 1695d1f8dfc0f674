"""Line dedup: drop lines whose normalised form occurs in several documents.

Lines are exploded with their position, normalised (ASCII white space stripped
at both ends, A-Z lower-cased), hashed to 128 bits and counted by distinct
document. A line over the threshold stays only in the smallest ``doc_id``
that holds it; the others are dropped and each document is put together again
by position.

Plan: the exploded table (ids, position, hash; no text) is staged once; the
counting is pre-aggregated before its shuffle, so a line that a third of all
documents hold costs one row per task; the keys to drop are staged, so that
the planner broadcasts them only if they are measured small, and otherwise
joins by sort-merge with both sides freshly shuffled, where adaptive
execution splits a hot key. Text is shuffled once, at reassembly.

Defined results: a null or empty text is one empty line; a null ``doc_id``
counts as larger than every other; repeated rows of one ``doc_id`` are one
document for the counting and each gets its own result row; ties (equal
lines within the smallest document) all stay; an empty table gives an empty
result; other columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import order_id, staged, text_or_empty

MIN_CHARS = 10
MIN_DOCS = 2
ASCII_SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A letter outside ASCII that lower() may change, or that this Java does not know.
_OTHER_CASED = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^\x00-\x7F]]"


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, nothing else. ``lower`` does the same, faster, where no other cased letter occurs."""
    return F.when(col.rlike(_OTHER_CASED), F.translate(col, UPPER, LOWER)).otherwise(F.lower(col))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def drop_positions(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(_d, _t, _drop)``: for each document that loses lines, its row key and their positions."""
    text = text_or_empty(text_col)
    keys = (
        docs.select(order_id(id_col).alias("_d"), F.xxhash64(text).alias("_t"), F.posexplode(_lines(text)).alias("_p", "_l"))
        .select("_d", "_t", "_p", line_key(F.col("_l")).alias("_k"))
        .filter(F.length("_k") >= min_chars)
        .select("_d", "_t", "_p", F.xxhash64("_k").alias("_h1"), F.xxhash64(F.lit(1), "_k").alias("_h2"))
    )
    keys = staged(keys, "lines")
    shared = (
        keys.groupBy("_h1", "_h2")
        .agg(F.count_distinct("_d").alias("_n"), F.min("_d").alias("_first"))
        .filter(F.col("_n") >= min_docs)
        .select("_h1", "_h2", "_first")
    )
    shared = staged(shared, "shared-lines")
    return (
        keys.join(shared, ["_h1", "_h2"])
        .filter(F.col("_d") > F.col("_first"))
        .groupBy("_d", "_t")
        .agg(F.collect_list("_p").alias("_drop"))
    )


def line_dedup(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    out_col: str = "text_kept",
) -> DataFrame:
    """All columns of ``docs`` plus the remaining text, ``n_lines`` (before) and ``n_dropped``."""
    text = text_or_empty(text_col)
    drops = drop_positions(docs, min_chars, min_docs, id_col, text_col)
    keyed = docs.select(F.struct("*").alias("_row"), order_id(id_col).alias("_d"), F.xxhash64(text).alias("_t"), text.alias("_x"))
    # The lines are bound once by the outer lambda; array_except is linear in the lines.
    kept = F.transform(
        F.array(_lines(F.col("_x"))),
        lambda ls: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_drop")),
                lambda i: F.get(ls, i),
            ),
            "\n",
        ),
    )[0]
    out = keyed.join(drops, ["_d", "_t"], "left")
    old = [c for c in docs.columns if c not in (out_col, "n_lines", "n_dropped")]
    return out.select(
        *[F.col("_row")[c].alias(c) for c in old],
        F.when(F.col("_drop").isNull(), F.col("_x")).otherwise(kept).alias(out_col),
        F.size(_lines(F.col("_x"))).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("_drop")), F.lit(0)).cast("long").alias("n_dropped"),
    )
