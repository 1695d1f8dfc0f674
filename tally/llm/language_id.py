"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of a bounded sample
of labelled texts. A text is reduced to its letters in lower case (runs of
anything else become one space), cut into chunks, each chunk is compressed
with every dictionary, and the language with the smallest total wins. The
margin is what the winner saves against the runner-up; a narrow margin is
rejected.

The classifier's bound: per language at most ``sample_rows`` rows (those with
the smallest id hash, short texts first) and ``dict_bytes`` of their text.
Only this model, ``languages * dict_bytes`` at most, passes the driver; it
reaches the tasks with the function. The whole of every text is compressed.
No shuffle but that of the sample's ids (limited per task before it).

Defined results: ``und`` with score 0 if a text is null or has no letter, or
if nothing was learned; ties go to the language with more learnable rows
(counted over all of them), then to the alphabetically first; each row gets one result row, also repeated ones and ones with a null id (which
are never learned from); an empty table gives an empty result; other columns
are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged, text_or_empty

SAMPLE_ROWS = 64
SAMPLE_TEXT = 4096
DICT_BYTES = 96 * 1024
CHUNK = 4096
LEVEL = 6
MIN_MARGIN = 0.02
FULL_MARGIN = 0.2
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text's letters in lower case; one space for any run between them."""
    return _OTHER.sub(" ", text.lower()).encode(errors="replace")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: ``crc32`` of the id as text is divisible by 5 (so is a null id, here)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def learn_dictionaries(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, dict_bytes: int = DICT_BYTES,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> dict[str, bytes]:
    """Language -> dictionary content, from rows that are not held out; the most frequent language first."""
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    long = F.octet_length(text_col) > SAMPLE_TEXT
    rank = Window.partitionBy("lang").orderBy("long", "h", "id")
    ids = (
        rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), long.alias("long"), F.xxhash64(id_col).alias("h"))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= sample_rows)
        .select("id", "lang", "rank")
    )
    ids = staged(ids, "language-sample")
    sample = (
        rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.substring(text_col, 1, dict_bytes).alias("text"))
        .join(ids, ["id", "lang"])
        .dropDuplicates(["lang", "rank"])
        .collect()
    )
    count = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    out: dict[str, bytes] = {lang: b"" for lang in sorted(count, key=lambda x: (-count[x], x))}
    for row in sorted(sample, key=lambda r: (r["lang"], r["rank"])):
        out[row["lang"]] = (out[row["lang"]] + letters(row["text"]) + b" ")[:dict_bytes]
    return out


class Compressors:
    """One compressor per language, built once per task."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs = list(dictionaries)
        self.each = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                level, source_size=CHUNK, dict_size=len(dictionaries[lang]),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            content.precompute_compress(compression_params=params)
            self.each.append(zstandard.ZstdCompressor(dict_data=content, compression_params=params))

    def sizes(self, text: bytes, chunk: int = CHUNK) -> list[int]:
        """Compressed bytes of the whole text by language, chunk by chunk."""
        pieces = [text[i : i + chunk] for i in range(0, len(text), chunk)] or [b""]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.each]


def verdict(sizes: list[int]) -> tuple[int, float]:
    """Index of the smallest (the first of equals), and what it saves against the runner-up (1 if there is none)."""
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    if len(sizes) == 1:
        return best, 1.0
    second = min(s for i, s in enumerate(sizes) if i != best)
    return best, (second - sizes[best]) / second


def identify_language(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id_col, lang_best, lang_pred, score, margin``.

    ``lang_best`` is the smallest language whatever the margin; ``lang_pred``
    is ``und`` where the margin is under ``min_margin``.
    """
    names = [id_col, "lang_best", "lang_pred", "score", "margin"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(dictionaries)
        for batch in batches:
            best, pred, margins = [], [], []
            for text, letter in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not letter or not compressors.langs:
                    best.append(UNKNOWN)
                    pred.append(UNKNOWN)
                    margins.append(0.0)
                    continue
                k, margin = verdict(compressors.sizes(letters(text)))
                best.append(compressors.langs[k])
                pred.append(compressors.langs[k] if margin >= min_margin else UNKNOWN)
                margins.append(margin)
            margin = np.array(margins, dtype=np.float64)
            score = np.clip(margin / FULL_MARGIN, 0.0, 1.0)
            yield pa.record_batch(
                [batch.column(0), pa.array(best, pa.string()), pa.array(pred, pa.string()), pa.array(score), pa.array(margin)], names=names
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"), text_or_empty(text_col).rlike(r"\p{L}").alias("_letter"))
    return rows.mapInArrow(scan, f"`{id_col}` {id_type}, lang_best string, lang_pred string, score double, margin double")
