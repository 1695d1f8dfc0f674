"""Substring search through trigram postings.

``build`` writes, for every searched column, which rows hold which three
letters in a row (small letters), ordered by trigram, and how many rows each
trigram has. ``candidates`` takes the rarest trigrams of a term, intersects
their rows, and leaves the rest to the search itself, which then runs over the
candidates alone; so a page equals that of the plain search, and the table is
not scanned for it. A term without three plain letters in a row, or whose
rarest trigram a large share of all rows has, is searched by scan, as an index
could not spare it anything; so no common trigram's postings are ever read.

Null values have no trigrams. Rows are named by ``key``, which must be unique.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import LOOKUP_ROW_GROUP, write_lookup
from .filters import search

RAREST = 4
SCAN_SHARE = 0.1
# Up to this many candidate keys are written into the filter of the scan as literals.
IN_LIST_MAX_KEYS = 1_000


def _trigrams(text):
    low = F.lower(text)
    n = F.length(low) - 2
    # the case keeps sequence() from counting down on short texts
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(low, i, F.lit(3))))


class SearchIndex:
    """The postings of a table's columns under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "registro_ans"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    @classmethod
    def build(cls, df: DataFrame, path: str, key: str = "registro_ans", columns: Sequence[str] = ("razao_social", "cnpj"),
              partitions: int | None = None, row_group_bytes: int | None = LOOKUP_ROW_GROUP) -> SearchIndex:
        """Write the index of ``df``; every column's postings come from one scan."""
        cells = F.array(*[F.struct(F.lit(c).alias("col"), _trigrams(F.col(c).cast("string")).alias("tri")) for c in columns])
        rows = df.select(F.col(key).alias("key"), F.explode(cells).alias("cell"))
        postings = rows.select(F.col("cell.col").alias("col"), F.explode("cell.tri").alias("trigram"), "key")
        write_lookup(postings, f"{path}/postings", ["trigram", "key"], partitions, row_group_bytes=row_group_bytes)
        stored = df.sparkSession.read.parquet(f"{path}/postings")
        counts = stored.groupBy("col", "trigram").agg(F.count(F.lit(1)).alias("n"))
        total = df.agg(F.lit("").alias("col"), F.lit("").alias("trigram"), F.count(F.lit(1)).alias("n"))
        write_lookup(counts.union(total), f"{path}/counts", ["trigram"], partitions, row_group_bytes=row_group_bytes)
        return cls(df.sparkSession, path, key)

    def _term_trigrams(self, term: str, literal: bool) -> list[str]:
        if not literal and "\\" in term:
            return []
        low = term.lower() if term.isascii() else self.spark.range(1).select(F.lower(F.lit(term))).first()[0]
        runs = [low] if literal else re.split("[%_]", low)
        return sorted({r[i : i + 3] for r in runs for i in range(len(r) - 2)})

    def candidates(self, term: str, literal: bool = False) -> DataFrame | None:
        """Keys of the rows that may match, or None where a scan is as good."""
        tri = self._term_trigrams(term, literal)
        if not tri:
            return None
        found = self.spark.read.parquet(f"{self.path}/counts").filter(F.col("trigram").isin([*tri, ""])).collect()
        total = next((r.n for r in found if not r.trigram), 0)
        columns: dict[str, dict[str, int]] = {}
        for r in found:
            if r.trigram:
                columns.setdefault(r["col"], {})[r.trigram] = r.n
        wanted = F.lit(False)
        needed = None
        for col, counts in columns.items():
            if len(counts) < len(tri):
                continue  # a trigram that no row of this column has
            rare = sorted(tri, key=lambda t: (counts[t], t))[:RAREST]
            if counts[rare[0]] > max(SCAN_SHARE * total, 1):
                return None
            rare = [t for t in rare if counts[t] <= max(SCAN_SHARE * total, 1)]
            wanted = wanted | ((F.col("col") == col) & F.col("trigram").isin(rare))
            needed = F.when(F.col("col") == col, len(rare)) if needed is None else needed.when(F.col("col") == col, len(rare))
        postings = self.spark.read.parquet(f"{self.path}/postings")
        if needed is None:
            return postings.select("key").limit(0)
        both = postings.filter(wanted).groupBy("key", "col").agg(F.count(F.lit(1)).alias("n"))
        return both.filter(F.col("n") == needed).select("key").distinct()

    def search(self, df: DataFrame, term: str | None, columns: Sequence[str] = ("razao_social", "cnpj"), literal: bool = False) -> DataFrame:
        """The rows that :func:`tally.operators.filters.search` finds."""
        keys = self.candidates(term, literal) if term else None
        if keys is None:
            return search(df, term, columns, literal)
        few = [r[0] for r in keys.limit(IN_LIST_MAX_KEYS + 1).collect()]
        if len(few) <= IN_LIST_MAX_KEYS:  # reaches the scan: row groups without these keys are skipped
            rows = df.filter(F.col(self.key).isin(few)) if few else df.limit(0)
        else:
            rows = df.join(keys.withColumnRenamed("key", self.key), self.key, "left_semi").select(*df.columns)
        return search(rows, term, columns, literal)
