"""Chat formatting: token-budgeted, turn-aligned training windows with a loss mask.

Prefix sums of the turn tokens choose the spans: the turns of a conversation
whose last token falls into the same cell of ``span_tokens`` form one span,
so a span never cuts a turn. A window is the leading system turn, the last
turns before the span as far as ``history_tokens`` reach, less the tokens of
the system turn, and the span. The
mask covers the assistant turns of the span only: what is repeated as
history, or as system turn, is never a target again, and each assistant turn
is a target exactly once.

A window holds at most ``history_tokens`` (or its system turn, if that is
longer), less than ``span_tokens``, and its first new turn: turns are never
cut, so one longer than a cell makes its window as much longer. Turn tokens are its words plus two marks (a real
tokenizer would need Python, which this native operator does without).

Template: ``<s>role\\ntext</s>`` per turn. In roles and texts ``\\``, ``<``
and ``[`` (and a line break in a role) become a back-slash and a letter, so
no control string can occur inside, and the reader undoes it exactly.

Plan: one shuffle, by conversation. The sums are running window functions
over sorted rows, which spill; only the turns of one window are collected
into one row. A history turn can reach ``ceil(history/span) + 1`` later spans
at most (each span in between ends in a later cell), so it is exploded to
that many and kept where its distance fits.

Defined results: null roles and texts are empty; a null ``turn`` comes first;
ties are ordered by role and text; repeated rows are turns of their own; rows
with a null conversation id form one conversation; an empty table gives an
empty result; other columns are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_TOKENS = 1024
HISTORY_TOKENS = 512
OPEN, CLOSE = "<s>", "</s>"

# Fixed values of the template: character -> letter after the back-slash; the back-slash first.
ESCAPES = (("\\", "b"), ("<", "l"), ("[", "s"))


def escape(col: Column, line_break: bool = False) -> Column:
    for char, letter in (*ESCAPES, *((("\n", "n"),) if line_break else ())):
        col = F.replace(col, F.lit(char), F.lit("\\" + letter))
    return col


def unescape(col: Column) -> Column:
    for char, letter in (("\n", "n"), *reversed(ESCAPES)):
        col = F.replace(col, F.lit("\\" + letter), F.lit(char))
    return col


def turn_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 2


def chat_windows(
    conversations: DataFrame,
    span_tokens: int = SPAN_TOKENS,
    history_tokens: int = HISTORY_TOKENS,
    target_role: str = "assistant",
    system_role: str = "system",
) -> DataFrame:
    """``conv_id, span, formatted, mask, n_repeated, n_tokens``.

    ``mask`` lists ``(start, end)`` in code points of ``formatted``, one per
    target turn, in order; the first ``n_repeated`` turns are repetitions.
    """
    turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    whole = Window.partitionBy("conv_id")
    rows = (
        conversations.select(
            "conv_id", "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("i", F.row_number().over(turn))
        .withColumn("lead", (F.col("i") == 1) & (F.col("role") == system_role))
        .withColumn("tok", turn_tokens(F.col("text")).cast("long"))
        .withColumn("t", F.when(F.col("lead"), F.lit(0)).otherwise(F.col("tok")))
        .withColumn("p_end", F.sum("t").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("p", F.col("p_end") - F.col("t"))
        .withColumn("cell", F.when(~F.col("lead"), F.floor((F.col("p_end") - 1) / span_tokens)))
        .withColumn("opens", (~F.col("lead") & ~F.lag("cell").over(turn).eqNullSafe(F.col("cell"))).cast("long"))
        .withColumn("s", F.sum("opens").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("spans", F.greatest(F.sum("opens").over(whole), F.lit(1)))
        .withColumn("system", F.sum(F.when(F.col("lead"), F.col("tok")).otherwise(0)).over(whole))
    )
    # the spans, counted from 1, in which a turn appears; its own is the first of them
    reach = math.ceil(history_tokens / span_tokens) + 1
    first = F.greatest(F.col("s"), F.lit(1))
    last = F.when(F.col("lead"), F.col("spans")).otherwise(F.least(F.col("s") + reach, F.col("spans")))
    span = Window.partitionBy("conv_id", "span")
    in_span = span.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    head = F.concat(F.lit(OPEN), escape(F.col("role"), line_break=True), F.lit("\n"))
    body = escape(F.col("text"))
    segments = (
        rows.withColumn("span", F.explode(F.sequence(first, last)))
        .withColumn("new", F.col("span") == first)
        .withColumn("p0", F.min(F.when(F.col("new") & ~F.col("lead"), F.col("p"))).over(span))
        .filter(F.col("new") | F.col("lead") | (F.col("system") + F.col("p0") - F.col("p") <= history_tokens))
        .withColumn("head", head)
        .withColumn("body", body)
        .withColumn("seg", F.concat("head", "body", F.lit(CLOSE)))
        .withColumn("end", F.sum(F.length("seg")).over(in_span) - len(CLOSE))
    )
    pieces = F.array_sort(F.collect_list(F.struct("i", "seg")))
    masked = F.struct((F.col("end") - F.length("body")).alias("start"), F.col("end").alias("end"))
    return segments.groupBy("conv_id", "span").agg(
        F.array_join(F.transform(pieces, lambda x: x["seg"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("new") & (F.col("role") == target_role), masked))).alias("mask"),
        F.count_if(~F.col("new")).alias("n_repeated"),
        F.sum("tok").alias("n_tokens"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Reads windows back: ``conv_id, span, turns, targets, n_chars``.

    ``turns`` are the new turns ``(role, text)``; ``targets`` the text under
    the mask, turn by turn.
    """
    parts = F.split("formatted", CLOSE)
    fresh = F.slice(parts, F.col("n_repeated").cast("int") + 1, F.size(parts) - 1 - F.col("n_repeated").cast("int"))

    turns = F.transform(
        F.transform(fresh, lambda part: F.split(F.substr(part, F.lit(len(OPEN) + 1)), "\n", 2)),
        lambda rt: F.struct(unescape(rt[0]).alias("role"), unescape(rt[1]).alias("text")),
    )
    targets = F.transform(
        "mask",
        lambda m: unescape(F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))),
    )
    return windows.select(
        "conv_id", "span", turns.alias("turns"), targets.alias("targets"), F.length("formatted").alias("n_chars")
    )
