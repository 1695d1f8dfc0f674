"""Delimited text scans.

* S7  file selection: recursive listing, extension filter (case-insensitive)
      and name exclusions, expressed as reader options and a filter on the
      ``_metadata`` file name (Spark prunes files by it).
* S8  dialect per file: the delimiter from its first line and the encoding
      from all its lines (decision D18) instead of trying one after the other
      (:mod:`tally.sources.records`), or per group of like files.
* S10 tolerant scan: rows with too many fields are dropped, short rows are
      kept NULL-padded (D19), and missing-value tokens become NULL.
* S12 staging load with a declared schema whose header is checked.
* H5  period columns taken from the folder path.

Every column is read as text (``inferSchema=False``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import NA_TOKENS, null_tokens
from ..operators.sets import union_all
from ..session import scratch_path
from .records import empty_frame, record_frames

# File-name fragments the ledger scan skips (revenue and asset
# statements), and the accepted extensions.
SKIP_NAME_PARTS = ("receita", "ativo")
CSV_GLOB = "*.[cC][sS][vV]"


def sniff_dialect(header_line: str) -> dict[str, str]:
    """Delimiter and encoding from a header line read as UTF-8 text.

    A replacement character means the bytes were not UTF-8 -> ISO-8859-1
    (which decodes any byte). ``;`` wins over ``,`` when both appear.
    """
    encoding = "ISO-8859-1" if "�" in header_line else "UTF-8"
    if ";" in header_line:
        sep = ";"
    elif "," in header_line:
        sep = ","
    elif "\t" in header_line:
        sep = "\t"
    else:
        sep = ";"
    return {"sep": sep, "encoding": encoding}


def header_line(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True,
                glob: str | None = CSV_GLOB,
                skip_name_parts: Sequence[str] = SKIP_NAME_PARTS) -> str | None:
    """First line of the first wanted file of a group: a one-row scan (bounded)."""
    r = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    text = _skip_names(r.text(paths if isinstance(paths, str) else list(paths)), skip_name_parts)
    rows = text.limit(1).collect()
    return rows[0][0] if rows else None


def _skip_names(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    name = F.lower(F.col("_metadata.file_name"))
    cond = None
    for p in parts:
        c = name.contains(p)
        cond = c if cond is None else cond | c
    return df if cond is None else df.filter(~cond)


def read_group(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str | None = None,
    encoding: str | None = None,
    recursive: bool = True,
    glob: str | None = CSV_GLOB,
    skip_name_parts: Sequence[str] = SKIP_NAME_PARTS,
    with_path: bool = True,
) -> DataFrame | None:
    """All-text scan of one file group (S7, S8, S11). ``None`` if the group is empty.

    Delimiter and encoding are sniffed from the group's header unless given.
    The source file path is kept as ``_source_path`` when ``with_path``.
    """
    if sep is None or encoding is None:
        head = header_line(spark, paths, recursive, glob, skip_name_parts)
        if head is None:
            return None
        d = sniff_dialect(head)
        sep = sep or d["sep"]
        encoding = encoding or d["encoding"]
    r = (spark.read.option("header", "true").option("inferSchema", "false")
         .option("sep", sep).option("encoding", encoding).option("escape", '"')
         .option("recursiveFileLookup", str(recursive).lower()))
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.csv(paths if isinstance(paths, str) else list(paths))
    df = _skip_names(df, skip_name_parts)
    if with_path:
        df = df.withColumn("_source_path", F.col("_metadata.file_path"))
    return df


def read_layouts(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True,
                 glob: str | None = CSV_GLOB,
                 skip_name_parts: Sequence[str] = SKIP_NAME_PARTS) -> list[DataFrame]:
    """All-text frames of loose files, one per distinct header.

    Every file is read once, in as many tasks as its size asks for, with its
    own delimiter, encoding and column order (:mod:`tally.sources.records`).
    Each frame carries ``_source_path``.
    """
    return record_frames(spark, paths, recursive, glob, skip_name_parts)


def period_from_path(df: DataFrame, path_col: str = "_source_path",
                     pattern: str = r"(\d{4})_T(\d)") -> DataFrame:
    """Year and quarter from the folder name (H5), e.g. ``.../2023_T1/file.csv``."""
    p = F.col(path_col)
    return df.withColumns({
        "ano": F.nullif(F.regexp_extract(p, pattern, 1), F.lit("")).cast("int"),
        "trimestre": F.nullif(F.regexp_extract(p, pattern, 2), F.lit("")).cast("int"),
    })


def read_tolerant(spark: SparkSession, paths: str | Sequence[str],
                  columns: Sequence[str] | None = None,
                  sep: str | None = None, encoding: str | None = None,
                  tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Tolerant all-text scan (S10, decision D19).

    Fields are counted on whole records, so separators and line breaks inside
    quotes count for nothing: records with more fields than the header are
    dropped, short ones are kept with NULLs, and any missing-value token
    becomes NULL. Without ``columns`` the names come from each file's own
    header, so later steps map them by name; the dialect is sniffed when not
    given.
    """
    frames = record_frames(spark, paths, recursive=False, sep=sep, encoding=encoding, tolerant=True, columns=columns)
    rows = union_all(frames).drop("_source_path") if frames else empty_frame(spark, columns or [])
    return rows.select(*[null_tokens(F.col(f"`{c}`"), tokens).alias(c) for c in rows.columns])


def read_ranked(spark: SparkSession, path: str, schema: StructType | str, sep: str = ";",
                encoding: str = "UTF-8", position: str = "pos") -> DataFrame:
    """An exported table with the place of each row in the export.

    A globally sorted write numbers its files in order, and a row's place in a
    file is its order. Rows are numbered without a sort: each piece of a file
    counts its own, and the counts of the pieces before it (one row a piece)
    are added. The rows are written once, so that both see the same pieces.
    """
    rows = (spark.read.schema(schema).option("header", "true").option("sep", sep).option("encoding", encoding)
            .option("escape", '"').csv(path))
    base = scratch_path(spark, f"ranked/{uuid.uuid4().hex}")
    rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_at")).write.parquet(base)
    rows = spark.read.parquet(base)
    pieces = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_file", "_block")) - F.col("_n")
    pieces = pieces.select("_file", "_block", (before - F.col("_first")).alias("_shift"))
    placed = rows.join(pieces, ["_file", "_block"]).withColumn(position, F.col("_at") + F.col("_shift") + 1)
    return placed.drop("_file", "_block", "_at", "_shift")


def read_staging(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                 sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Staging load with a declared schema.

    ``enforceSchema=false`` makes Spark compare the file header with the
    schema and fail on a mismatch instead of silently mis-assigning columns.
    """
    return (spark.read.schema(schema).option("header", "true").option("sep", sep)
            .option("encoding", encoding).option("escape", '"').option("enforceSchema", "false")
            .csv(path if isinstance(path, str) else list(path)))
