"""Quality rules: divergence of a text's histograms from its language's.

Two histograms describe a text: its characters by class (small and capital
letters, digits, white space, sentence punctuation, other ASCII signs, other
code points) and its words by the common words of its language (everything
else is one bin), in small letters and without punctuation at their edges.
Each is compared with the language's histogram by the Jensen-Shannon distance
(base 2, so 0 to 1). A text is rejected when a distance is over its threshold
and the text is long enough for that histogram to mean anything.

A text without any common word has a distance of its own to each reference,
and a good text lies the nearer to it the longer it is. So the threshold of
the words follows reference and length: from the distance that ``OWN_SHARE``
of texts drawn from the reference stay under, it goes by ``MARGIN`` of the way
to the distance of no common word, and it is never over ``max_word``. The reference of all languages
says nothing on the spread of one, there ``max_word`` holds alone.

The references are counted over all documents: one pass adds up classes and
words per task, the counts are summed per language and word hash after a
partial aggregation, and the most frequent words per language, and of all
languages together, are ranked with a limit per task. Only the references (``common_words + 9`` numbers per
language) pass the driver. The second pass judges text by text; there is no
other shuffle. A language with fewer than ``MIN_REFERENCE`` words uses the
reference of all languages together.

Base counts, used by the registered query: words, code points in words,
symbols, repeated lines and words in repeated five-word windows; equality of
lines and windows is that of 64-bit hashes within one text.

Defined results: a null or empty text has no words (``base_failed``); a null
language is a language of its own; each row gets one result row, also
repeated ones and ones with a null id; ties in the word ranking go to the
smaller hash; an empty table gives an empty result; other columns pass
through ``quality_filter`` and are dropped by ``quality_scores``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._bytes import Spans, U, Words, mix, row_slices, text_bytes
from ._common import staged, text_or_empty, tidied

COMMON_WORDS = 50
MIN_REFERENCE = 2000
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.48
OWN_SHARE = 0.995
MARGIN = 0.2
DRAWS = 2000
MIN_BASE_WORDS = 10
MAX_REPEAT_PERCENT = 20
SLICE_BYTES = 1 << 20
N_CLASSES = 8
OVERALL = "\0"

# Character classes by UTF-8 byte; 7 (a continuation byte) counts nowhere.
CLASS = np.full(256, 5, dtype=np.uint8)
CLASS[ord("a") : ord("z") + 1] = 0
CLASS[ord("A") : ord("Z") + 1] = 1
CLASS[ord("0") : ord("9") + 1] = 2
CLASS[[9, 10, 11, 12, 13, 32]] = 3
CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
CLASS[0xC0:] = 6
CLASS[0x80:0xC0] = 7
SYMBOL = np.zeros(256, dtype=np.int64)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
# Punctuation: ASCII, and by its first bytes that of Latin-1 and U+2000 to U+206F.
EDGE = np.zeros(256, dtype=bool)
EDGE[[ord(c) for c in "!\"#%&'()*,-./:;?@[\\]_{}"]] = True
EDGE_C2 = np.zeros(256, dtype=bool)
EDGE_C2[[0xA1, 0xA7, 0xAB, 0xB6, 0xB7, 0xBB, 0xBF]] = True
LENGTHS = np.array([10, 20, 35, 50, 70, 100, 150, 200, 300, 500, 1000, 2000, 5000, 20000])


@dataclass(frozen=True)
class Reference:
    """Histograms by language; ``words`` are hashes, ``shares`` end with the bin of all other words.

    ``cuts`` has the largest word distance of a good text for each of ``LENGTHS``.
    """

    classes: dict[str, np.ndarray]
    words: dict[str, np.ndarray]
    shares: dict[str, np.ndarray]
    cuts: dict[str, np.ndarray] = field(default_factory=dict)

    def of(self, lang: str | None) -> str:
        return lang if lang in self.classes else OVERALL


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of ``p`` to ``q``; rows without mass give 0."""
    total = p.sum(axis=1, keepdims=True)
    p = np.divide(p, total, out=np.zeros_like(p, dtype=float), where=total > 0)
    q = np.broadcast_to(q, p.shape)
    m = (p + q) / 2

    def half(x: np.ndarray) -> np.ndarray:
        ratio = np.divide(x, m, out=np.ones_like(m), where=(x > 0) & (m > 0))
        return (x * np.log2(ratio)).sum(axis=1)

    out = np.sqrt(np.clip((half(p) + half(q)) / 2, 0, 1))
    return np.where(total[:, 0] > 0, out, 0.0)


def word_cuts(share: np.ndarray) -> np.ndarray:
    """For each of ``LENGTHS``, between own texts and a text without a common word."""
    none = js_distance(np.eye(len(share))[-1:], share)[0]
    draw = np.random.default_rng(0)
    own = [np.quantile(js_distance(draw.multinomial(n, share, DRAWS).astype(float), share), OWN_SHARE) for n in LENGTHS]
    own = np.minimum(own, none)
    return own + MARGIN * (none - own)


def plain_words(texts: pa.Array) -> Words:
    """The words in small letters, hashed without punctuation at their edges; one of nothing else stays as it is."""
    buf, offsets = text_bytes(pc.utf8_lower(texts))
    spans = Spans(buf)
    words = Words(buf, offsets, spans)
    after = np.append(buf, np.zeros(2, np.uint8))
    edge = EDGE[buf]
    two = np.flatnonzero((buf == 0xC2) & EDGE_C2[after[1:-1]])
    three = np.flatnonzero((buf == 0xE2) & ((after[1:-1] == 0x80) | ((after[1:-1] == 0x81) & (after[2:] < 0xB0))))
    for at in (two, two + 1, three, three + 1, three + 2):
        edge[at] = True
    core = np.flatnonzero(~edge)
    a, b = np.searchsorted(core, words.start), np.searchsorted(core, words.end)
    has = b > a
    start, end = words.start.copy(), words.end.copy()
    start[has], end[has] = core[a[has]], core[b[has] - 1] + 1
    words.hash = spans.hash(start, end)
    return words


def _class_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    row = np.repeat(np.arange(n, dtype=np.int64) * N_CLASSES, np.diff(offsets))
    return np.bincount(row + CLASS[buf], minlength=n * N_CLASSES).reshape(n, N_CLASSES)[:, : N_CLASSES - 1]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buf, offsets = text_bytes(batch.column(column))
    for i, j in row_slices(offsets, SLICE_BYTES):
        yield i, j, buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(lang, kind, key, n)`` of one task: kind 0 has classes, kind 1 words, kind 2 all words."""
    held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
    sums: dict[str | None, np.ndarray] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            key, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([c for _, c in parts]), minlength=len(key)).astype(np.int64)
            for at in range(0, len(key), 100_000):
                k = key[at : at + 100_000].view(np.int64)
                yield _rows(lang, 1, k, n[at : at + 100_000])
        held.clear()

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for i, j, buf, offsets in _slices(batch, 0):
            words = plain_words(batch.column(0).slice(i, j - i))
            classes = _class_counts(buf, offsets)
            by: dict[str | None, list[int]] = {}
            for r in range(i, j):
                by.setdefault(langs[r], []).append(r - i)
            doc = words.doc()
            for lang, rows in by.items():
                mine = np.zeros(j - i, dtype=bool)
                mine[rows] = True
                key, n = np.unique(words.hash[mine[doc]], return_counts=True)
                held.setdefault(lang, []).append((key, n))
                size += len(key)
                total = np.append(classes[rows].sum(axis=0), n.sum())
                sums[lang] = sums.get(lang, 0) + total
            if size > 4_000_000:
                yield from flush()
                size = 0
    yield from flush()
    for lang, total in sums.items():
        yield _rows(lang, 0, np.arange(len(total), dtype=np.int64), total.astype(np.int64))


def _rows(lang: str | None, kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([lang] * len(key), pa.string()), pa.array(np.full(len(key), kind, dtype=np.int32)), pa.array(key), pa.array(n)],
        names=["lang", "kind", "key", "n"],
    )


def learn_reference(docs: DataFrame, common_words: int = COMMON_WORDS, text_col: str = "text", lang_col: str = "lang") -> Reference:
    """Histograms of every language, counted over all documents."""
    rows = docs.select(text_or_empty(text_col).alias("t"), F.col(lang_col).alias("lang"))
    counts = rows.mapInArrow(tidied(_totals), "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    counts = staged(counts, "quality-counts")
    rank = Window.partitionBy("lang", "kind").orderBy(F.col("n").desc(), "key")
    top = counts.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= max(common_words, N_CLASSES)).collect()
    classes: dict[str | None, np.ndarray] = {}
    words: dict[str | None, list[tuple[int, int]]] = {}
    for r in top:
        if r["kind"] == 0:
            classes.setdefault(r["lang"], np.zeros(N_CLASSES))[r["key"]] = r["n"]
        elif r["rank"] <= common_words:
            words.setdefault(r["lang"], []).append((r["key"], r["n"]))
    everything = counts.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "key").limit(common_words)
    words[OVERALL] = [(r["key"], r["n"]) for r in everything.collect()]
    classes[OVERALL] = sum(classes.values(), np.zeros(N_CLASSES))
    out = Reference({}, {}, {})
    for lang, c in classes.items():
        total_words, c = c[-1], c[:-1]
        if lang != OVERALL and total_words < MIN_REFERENCE:
            continue
        pairs = sorted(words.get(lang, []))
        n = np.array([x[1] for x in pairs] + [max(0.0, total_words - sum(x[1] for x in pairs))], dtype=float)
        out.classes[lang] = c / max(c.sum(), 1)
        out.words[lang] = np.array([x[0] for x in pairs], dtype=np.int64).view(U)
        out.shares[lang] = n / max(n.sum(), 1)
    # sorted by the unsigned hash, as searchsorted needs
    for lang, keys in out.words.items():
        order = np.argsort(keys)
        out.words[lang] = keys[order]
        out.shares[lang] = np.append(out.shares[lang][:-1][order], out.shares[lang][-1])
        if lang != OVERALL:
            out.cuts[lang] = word_cuts(out.shares[lang])
    return out


def base_counts(buf: np.ndarray, offsets: np.ndarray, spans: Spans, words: Words) -> dict[str, np.ndarray]:
    """Per text: words, code points in words, symbols, repeated lines, words in repeated five-word windows."""
    n = len(offsets) - 1
    length = np.diff(offsets)
    row = np.repeat(np.arange(n), length)
    lead = words.solid & ((buf & 0xC0) != 0x80)

    # lines with a word that equal an earlier one of the text
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    doc = np.searchsorted(offsets[1:], starts, side="right") if n else starts
    at = np.append(starts[1:], len(buf)) if len(starts) else starts
    inside = starts < len(buf)
    starts, at, doc = starts[inside], at[inside], doc[inside]
    ends = np.minimum(offsets[doc + 1], at)
    broken = (ends > starts) & (buf[np.maximum(ends - 1, 0)] == 10)
    ends = ends - broken
    has = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends, doc = starts[has], ends[has], doc[has]
    key = mix(spans.hash(starts, ends) + doc.astype(U) * U(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), dtype=bool)
    again[first] = False

    # windows of five words found twice or more
    shingle, sdoc, sat = words.shingles(5, short=False)
    key = mix(shingle + sdoc.astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = key[1:] == key[:-1]
    twice = order[same[1:] | same[:-1]]
    step = np.zeros(len(words.hash) + 6, dtype=np.int64)
    np.add.at(step, sat[twice], 1)
    np.add.at(step, sat[twice] + 5, -1)
    covered = np.cumsum(step)[: len(words.hash)] > 0
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": np.bincount(row, weights=lead, minlength=n).astype(np.int64),
        "n_symbols": np.bincount(row, weights=SYMBOL[buf], minlength=n).astype(np.int64),
        "n_dup_lines": np.bincount(doc[again], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(words.doc(), weights=covered, minlength=n).astype(np.int64),
    }


def distances(
    buf: np.ndarray, offsets: np.ndarray, words: Words, langs: list[str | None], ref: Reference
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: code points, class distance, common-word distance."""
    classes = _class_counts(buf, offsets)
    chars = classes.sum(axis=1)
    names = [ref.of(x) for x in langs]
    by_class, by_word = np.zeros(len(langs)), np.zeros(len(langs))
    doc = words.doc()
    for lang in set(names):
        rows = np.array([i for i, x in enumerate(names) if x == lang])
        by_class[rows] = js_distance(classes[rows].astype(float), ref.classes[lang])
        number = np.full(len(langs), -1)
        number[rows] = np.arange(len(rows))
        mine = number[doc] >= 0
        key, common = words.hash[mine], ref.words[lang]
        width = len(common) + 1
        spot = np.searchsorted(common, key)
        if len(common):
            spot[common[np.minimum(spot, len(common) - 1)] != key] = len(common)
        hist = np.bincount(number[doc[mine]] * width + spot, minlength=len(rows) * width).reshape(len(rows), width)
        by_word[rows] = js_distance(hist.astype(float), ref.shares[lang])
    return chars, by_class, by_word


def word_limits(counts: np.ndarray, langs: list[str | None], ref: Reference, most: float) -> np.ndarray:
    """Per text: the largest word distance that a text of so many words may have."""
    out = np.full(len(langs), most)
    names = [ref.of(x) for x in langs]
    for lang in set(names) & set(ref.cuts):
        rows = np.array([i for i, x in enumerate(names) if x == lang])
        out[rows] = np.minimum(most, np.interp(np.log(np.maximum(counts[rows], 1)), np.log(LENGTHS), ref.cuts[lang]))
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_scores(
    docs: DataFrame, ref: Reference, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
) -> DataFrame:
    """``id_col``, the base counts, ``base_failed``, both distances, ``kept``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for i, j, buf, offsets in _slices(batch, 1):
                spans = Spans(buf)
                words = Words(buf, offsets, spans)
                base = base_counts(buf, offsets, spans, words)
                plain = plain_words(batch.column(1).slice(i, j - i))
                chars, by_class, by_word = distances(buf, offsets, plain, langs[i:j], ref)
                limit = word_limits(plain.count, langs[i:j], ref, max_word)
                failed = (base["n_words"] < MIN_BASE_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
                far = ((chars >= min_chars) & (by_class > max_class)) | ((base["n_words"] >= min_words) & (by_word > limit))
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), *(pa.array(base[c]) for c in COUNTS), pa.array(failed),
                     pa.array(by_class), pa.array(by_word), pa.array(~failed & ~far)],
                    names=[id_col, *COUNTS, "base_failed", "class_distance", "word_distance", "kept"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_t"), F.col(lang_col).alias("_l"))
    return rows.mapInArrow(tidied(scan), f"`{id_col}` {id_type}, {counts}, base_failed boolean, class_distance double, word_distance double, kept boolean")


def quality_filter(docs: DataFrame, ref: Reference, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are."""
    packed = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    kept = quality_scores(packed, ref, "_row", "_text", "_lang").filter("kept")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
