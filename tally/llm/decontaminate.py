"""Benchmark decontamination by template canonicalisation and plain words.

Words with a digit become a number placeholder, unit words right after one a
unit placeholder, words that begin with a capital a name placeholder; other
words are lower-cased. Benchmark items and documents are cut into windows of
five such words, hashed, and joined; so are, beside them, the windows of the
plain words: small letters, no punctuation at the edges, no placeholder. A
window of an item is matched if either form is. A document that holds at least
``threshold`` of an item's windows is a candidate. Then the slots are
compared: along one alignment (document position minus item position) each
value of the item must stand for one value of the document. A window with a
value that does not is dropped, unless it matches in the plain form. So an
item is found as it is, in any case, and also with other numbers, names and
units, but not where the placeholders merely happen to line up.

Plan: native functions only. The item windows are staged, so the planner
broadcasts them if they are measured small, and otherwise sorts both sides,
where adaptive execution splits a hot window. A document's words are split off
and hashed once a form; a window's hash is made of its words'. The document
side carries three longs a window and form, and no text; only windows that match go on. Slot
values are read from candidate documents alone.

Defined results: item windows with under ``MIN_LITERALS`` literal words say
too little and do not count, unless the item has no other: then all its windows
count, in the plain form. An item under five words is one window of all its
words, plain; one under ``MIN_WORDS`` words is found only in a document that has
no others, as such words stand in any text. A null or empty text has no window;
every distinct text of an item is searched, and the one most of which is found
is reported, with the windows that match in either form; rows with a null item
id are ignored; repeated rows of a document are judged as one, and a null
``doc_id`` is an id of its own; an empty table gives an empty result;
other columns pass through ``decontaminate`` and are dropped by ``leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import MAX_ID, order_id, staged, text_or_empty

WINDOW = 5
THRESHOLD = 0.8
MIN_LITERALS = 2
MIN_WORDS = 3
NUMBER, UNIT, NAME = "\x01", "\x02", "\x03"

# Unit words that make a slot when they follow a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "meter", "meters",
    "metre", "metres", "mg", "g", "kg", "gram", "grams", "ton", "tons", "oz", "ounce", "ounces", "lb", "lbs", "pound",
    "pounds", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "minute",
    "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars",
    "cent", "cents", "euro", "euros", "percent", "degree", "degrees", "mph", "kmh", "watt", "watts", "volt", "volts",
)

_NUMBER = r"(?<!\S)\S*?[0-9]\S*"
_UNIT = r"(?i)\x01(\s{1,8})(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")[.,;:!?)]*(?!\S)"
# the look ahead turns most places away at once
_NAME = r"(?=[\p{P}\p{Lu}])(?<!\S)\p{P}*+\p{Lu}\S*"
_PUNCTUATION = r"^\p{P}+|\p{P}+$"
_EDGES = r"(?=\p{P})(?:(?<!\S)\p{P}++(?=\S)|(?<=[^\s\p{P}])\p{P}++(?!\S))"


def template(text: Column) -> Column:
    """The text with typed placeholders; it has the same white space, so words keep their positions."""
    t = F.regexp_replace(text, _NUMBER, NUMBER)
    t = F.regexp_replace(t, _UNIT, f"{NUMBER}$1{UNIT}")
    return F.lower(F.regexp_replace(t, _NAME, NAME))


def words_of(text: Column) -> Column:
    return F.split(text, r"\s+")


def plain(text: Column) -> Column:
    """The text in small letters without punctuation at word edges; words of nothing else stay, so positions do too."""
    return F.regexp_replace(F.lower(text), _EDGES, "")


def _windows(hashes: Column, size: int, *more: Column) -> Column:
    """One hash for each window, from the hashes of its words; null where there are fewer words."""
    at = F.sequence(F.lit(0), F.size(hashes) - size)
    every = F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)], *more))
    return F.when(F.size(hashes) >= size, every)


def _of_words(words: Column, windows) -> Column:
    """``windows(hashes)`` where each word is split off and hashed once."""
    once = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(F.array(once), windows)[0]


def window_hashes(text: Column, size: int = WINDOW) -> Column:
    """One hash for each window of template words, by position."""
    return _of_words(words_of(template(text)), lambda h: _windows(h, size))


def plain_hashes(text: Column, *sizes: int) -> Column:
    """For each size, one hash for each window of plain words, by position; never that of a template window.

    Windows under ``MIN_WORDS`` words count only where they are the whole text.
    """

    def all_sizes(h: Column) -> Column:
        return F.array(*[_windows(h, k, F.lit(k)) if k >= MIN_WORDS else F.when(F.size(h) == k, _windows(h, k, F.lit(k))) for k in sizes])

    return _of_words(words_of(plain(text)), all_sizes)


def item_texts(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, v, x, m)``: the distinct texts of every item, numbered by hash, and their words."""
    x = F.trim(text_or_empty(text_col))
    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.xxhash64(x).alias("v"), x.alias("x"))
    return rows.filter("x != ''").dropDuplicates(["item_id", "v"]).withColumn("m", F.size(words_of(F.col("x"))))


def item_windows(texts: DataFrame, size: int) -> DataFrame:
    """``(item_id, v, ipos, h, plain, n)``: the windows of every text that count, in both forms, and how many count.

    The windows that say enough count; in a text without any, all do, in the plain form alone.
    """
    words = words_of(template(F.col("x")))
    w = texts.select("item_id", "v", words.alias("w"), F.posexplode(window_hashes(F.col("x"), size)).alias("ipos", "h"))
    literal = F.size(F.filter(F.slice("w", F.col("ipos") + 1, size), lambda x: ~x.isin(NUMBER, UNIT, NAME)))
    w = staged(w.filter(literal >= MIN_LITERALS).select("item_id", "v", "ipos", "h"), "item-windows")
    # a text under the window's size is one window of all its words
    h = F.get(plain_hashes(F.col("x"), *range(1, size + 1)), F.least("m", F.lit(size)) - 1)
    p = texts.select("item_id", "v", F.posexplode(h).alias("ipos", "h"))
    key = ["item_id", "v"]
    p = p.join(w.select(*key, "ipos"), [*key, "ipos"], "left_semi").unionByName(p.join(w.select(*key), key, "left_anti"))
    n = p.groupBy(*key).agg(F.count("*").alias("n"))
    return w.withColumn("plain", F.lit(False)).unionByName(p.withColumn("plain", F.lit(True))).join(n, key)


def slots(rows: DataFrame, text: Column, *keys: str) -> DataFrame:
    """``keys, at, kind, value``: the placeholders of each text and what they stand for."""
    pairs = F.arrays_zip(words_of(template(text)).alias("kind"), words_of(F.lower(text)).alias("value"))
    return (
        rows.select(*keys, F.posexplode(pairs).alias("at", "p"))
        .filter(F.col("p.kind").isin(NUMBER, UNIT, NAME))
        .select(*keys, "at", F.col("p.kind").alias("kind"), F.regexp_replace("p.value", _PUNCTUATION, "").alias("value"))
    )


def leaks(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = WINDOW,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(d, t, item_id, n_matched, n_windows, same_slots)`` for each document and item that it holds.

    ``d`` and ``t`` are the document's key: its id (null: the largest long)
    and the hash of its text.
    """
    texts = staged(item_texts(items, item_col, item_text), "benchmark-texts")
    windows = staged(item_windows(texts, size), "benchmark-windows")
    short = sorted(r[0] for r in texts.filter(F.col("m") < size).select("m").distinct().collect())
    trimmed = F.trim(text_or_empty(text_col))
    keyed = docs.select(order_id(id_col).alias("d"), F.xxhash64(text_or_empty(text_col)).alias("t"), trimmed.alias("x"))
    forms = F.concat(F.array(window_hashes(F.col("x"), size)), plain_hashes(F.col("x"), *short, size))
    forms = F.filter(forms, lambda x: x.isNotNull())
    found = keyed.select("d", "t", F.explode(forms).alias("f")).select("d", "t", F.posexplode("f").alias("pos", "h")).join(windows, "h")
    pair = ["d", "t", "item_id", "v"]
    found = found.groupBy(*pair, "n", "pos", "ipos").agg(F.bool_or("plain").alias("plain"))
    found = staged(found, "matched-windows")
    enough = F.col("hits") >= F.col("n") * threshold - 1e-9
    likely = found.groupBy(*pair, "n").agg(F.count_distinct("ipos").alias("hits")).filter(enough).select(*pair)
    found = staged(found.join(likely, pair, "left_semi").withColumn("shift", F.col("pos") - F.col("ipos")), "candidate-windows")

    # one plan at every size: the texts are sorted to the candidates; plain windows have the item's values
    in_doc = keyed.hint("merge").join(found.filter("not plain").select("d", "t").distinct(), ["d", "t"], "left_semi").dropDuplicates(["d", "t"])
    in_doc = slots(in_doc, F.col("x"), "d", "t").select("d", "t", "at", "value")
    in_item = slots(texts, F.col("x"), "item_id", "v").select(
        "item_id", "v", F.col("at").alias("iat"), F.col("kind").alias("ikind"), F.col("value").alias("ivalue")
    )
    line = [*pair, "shift"]
    covered = found.select(*line, "plain", F.explode(F.sequence("ipos", F.col("ipos") + (size - 1))).alias("iat"))
    covered = covered.groupBy(*line, "iat").agg(F.bool_or("plain").alias("plain"))
    aligned = covered.join(in_item, ["item_id", "v", "iat"]).withColumn("at", F.col("iat") + F.col("shift"))
    values = aligned.filter("not plain").join(in_doc, ["d", "t", "at"]).select(*line, "iat", "ikind", "ivalue", "value")
    values = staged(values.unionByName(aligned.filter("plain").select(*line, "iat", "ikind", "ivalue", F.col("ivalue").alias("value"))), "slot-values")
    torn = values.groupBy(*line, "ikind", "ivalue").agg(F.min("value").alias("a"), F.max("value").alias("b")).filter("a != b")
    torn = values.join(torn, [*line, "ikind", "ivalue"], "left_semi")
    torn = torn.select(*line, F.explode(F.sequence(F.col("iat") - (size - 1), "iat")).alias("ipos"), F.lit(True).alias("torn")).distinct()
    whole = found.join(torn, [*line, "ipos"], "left").filter("plain or torn is null")
    rows = whole.groupBy(*pair, "n").agg(F.count_distinct("ipos").alias("hits"), F.bool_and("plain").alias("same_slots")).filter(enough)
    # of several texts of an item, the one most of which is found
    best = F.struct(F.col("hits") / F.col("n"), "hits", "v", "n", "same_slots")
    return rows.groupBy("d", "t", "item_id").agg(F.max(best).alias("b")).select(
        "d", "t", "item_id", F.col("b.hits").alias("n_matched"), F.col("b.n").alias("n_windows"), F.col("b.same_slots").alias("same_slots")
    )


def leaked_ids(found: DataFrame) -> DataFrame:
    """The leaks with the document's id as it was: ``doc_id`` instead of ``d`` and ``t``."""
    doc_id = F.when(F.col("d") == MAX_ID, F.lit(None).cast("long")).otherwise(F.col("d")).alias("doc_id")
    return found.select(doc_id, "item_id", "n_matched", "n_windows", "same_slots")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    bad = staged(leaks(docs, items, id_col=id_col, text_col=text_col, **options).select("d", "t").distinct(), "leaking-documents")
    rows = docs.select(F.struct("*").alias("_row"), order_id(id_col).alias("d"), F.xxhash64(text_or_empty(text_col)).alias("t"))
    return rows.join(bad, ["d", "t"], "left_anti").select(*[F.col("_row")[c].alias(c) for c in docs.columns])
