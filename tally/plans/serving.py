"""Served queries (R1-R5): what the dashboard API answers, as DataFrames.

Each is ``(dim, fact, args) -> DataFrame``; an empty frame stands for "not
found". Envelopes that hold lists are built from already-bounded row sets
(one page, top k), never from a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_text
from ..operators.aggregates import filtered_count
from ..operators.filters import normalised_key_equals, search
from ..operators.search_index import SearchIndex
from ..operators.ordering import asc, desc, page, top_k

LISTING_COLUMNS = ("registro_ans", "cnpj", "razao_social", "uf")


def _found(dim: DataFrame, term: str | None, literal: bool, index: SearchIndex | None) -> DataFrame:
    """The operators that match, through the search index where there is one."""
    rows = dim.select(*LISTING_COLUMNS)
    return search(rows, term, literal=literal) if index is None else index.search(rows, term, literal=literal)


def listing_rows(dim: DataFrame, term: str | None = None, page_no: int = 1,
                 limit: int = 10, literal: bool = False, index: SearchIndex | None = None) -> DataFrame:
    """One page of the operator listing ordered by key (F4 + T3)."""
    found = _found(dim, term, literal, index)
    return page(found, [asc("registro_ans")], page_no, limit)


def listing_rows_after(dim: DataFrame, term: str | None = None, after=None, limit: int = 10,
                       literal: bool = False) -> DataFrame:
    """Keyset-paged listing: the page after operator key ``after`` (F4 + T3 keyset)."""
    from ..operators.ordering import page_after

    found = search(dim.select(*LISTING_COLUMNS), term, literal=literal)
    return page_after(found, "registro_ans", after, limit)


def listing_total(dim: DataFrame, term: str | None = None, literal: bool = False,
                  index: SearchIndex | None = None) -> DataFrame:
    """Number of operators matching the search."""
    return filtered_count(_found(dim, term, literal, index))


def listing(dim: DataFrame, term: str | None = None, page_no: int = 1, limit: int = 10,
            literal: bool = False, index: SearchIndex | None = None) -> DataFrame:
    """Envelope ``{data[], total, page, limit}`` as one row."""
    rows = listing_rows(dim, term, page_no, limit, literal, index)
    data = rows.agg(
        F.coalesce(
            F.sort_array(F.collect_list(F.struct(*LISTING_COLUMNS))),
            F.array().cast("array<struct<registro_ans:bigint,cnpj:string,"
                           "razao_social:string,uf:string>>"),
        ).alias("data")
    )
    total = listing_total(dim, term, literal, index)
    return one_row([data, total]).select(
        "data", "total", F.lit(page_no).alias("page"), F.lit(limit).alias("limit")
    )


def one_row(parts: list[DataFrame]) -> DataFrame:
    """Combine single-row frames with disjoint columns into one row.

    Union by name (each part fills its own columns, NULL elsewhere) and one
    global aggregate that keeps the non-NULL value of every column: no join
    of any kind is needed to put the pieces side by side.
    """
    from ..operators.sets import union_all

    merged = union_all(parts)
    return merged.agg(*[F.first(c, ignorenulls=True).alias(c) for c in merged.columns])


def operator_detail(dim: DataFrame, cnpj: str) -> DataFrame:
    """The operator whose digits-only tax id equals the argument's (R2).

    Several matches resolve to the lowest key; no match is an empty frame.
    """
    hit = normalised_key_equals(dim, "cnpj", cnpj, stored="cnpj_digits")
    return top_k(hit.select("registro_ans", "cnpj", "razao_social", "uf", "modalidade"),
                 [asc("registro_ans")], 1)


# Up to this many operator keys are written into the fact filter as literals.
IN_LIST_MAX_KEYS = 1_000


def expense_history(fact: DataFrame, dim: DataFrame, cnpj: str,
                    max_keys: int = IN_LIST_MAX_KEYS) -> DataFrame:
    """Expense rows of the operator(s) with this tax id, latest first.

    The operators are looked up first. When few (the usual case: one), their
    keys go into the fact scan as a literal ``IN`` list, which parquet
    statistics can use to skip row groups of a key-sorted fact; with more
    keys a semi join does the same work (every key is kept either way).
    """
    ops = normalised_key_equals(dim, "cnpj", cnpj, stored="cnpj_digits").select("registro_ans")
    keys = [r[0] for r in ops.limit(max_keys + 1).collect()]
    if len(keys) <= max_keys:
        rows = fact.filter(F.col("registro_ans").isin(keys)) if keys else fact.limit(0)
    else:
        rows = fact.join(ops, "registro_ans", "left_semi")
    out = rows.select(
        "ano", "trimestre",
        date_text(F.col("data_referencia")).alias("data_referencia"),
        F.col("valor_despesa").cast("double").alias("valor_despesa"),
        F.col("data_referencia").alias("_d"),
        F.col("valor_despesa").alias("_v"),
    )
    # ORDER BY date DESC; the value then makes the order total
    return out.orderBy(desc("_d"), desc("_v")).drop("_d", "_v")


def top_operators(fact: DataFrame, dim: DataFrame, k: int = 5) -> DataFrame:
    """Top-k operators by total expense (A10 + T2)."""
    per_op = fact.groupBy("registro_ans").agg(F.sum("valor_despesa").alias("total"))
    named = per_op.join(dim.select("registro_ans", "razao_social"), "registro_ans", "inner")
    return top_k(named, [desc("total"), asc("registro_ans")], k)


def top_state_totals(fact: DataFrame, dim: DataFrame, k: int = 10) -> DataFrame:
    """Top-k states by total expense (A3 + T2), NULL states excluded."""
    per_op = fact.groupBy("registro_ans").agg(F.sum("valor_despesa").alias("_t"))
    states = dim.filter(F.col("uf").isNotNull()).select("registro_ans", "uf")
    by_state = per_op.join(states, "registro_ans", "inner").groupBy("uf").agg(
        F.sum("_t").alias("total")
    )
    return top_k(by_state, [desc("total"), asc("uf")], k)


def statistics(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Dashboard KPIs as one row (R4): total, mean per operator, top-5
    operators and top-10 states as ``array<struct<nome, total>>``.

    All four answers come from one per-operator aggregate (the fact is
    scanned and shuffled once; the identical exchange is reused by every
    branch): the grand total is the sum of the operator totals (exact in
    decimal), the mean is their average, and both rankings join the
    per-operator table, not the fact, to the dimension.
    """
    per_op = fact.groupBy("registro_ans").agg(F.sum("valor_despesa").alias("total"))
    sums = per_op.agg(F.sum("total").alias("_s"), F.count(F.lit(1)).alias("_n"))
    total = sums.select(
        F.coalesce(F.col("_s"), F.lit(0)).cast("double").alias("total_despesas"))
    mean = sums.select(
        F.coalesce(F.round(F.col("_s") / F.col("_n").cast("decimal(20,0)"), 2), F.lit(0))
        .cast("double").alias("media_por_operadora"))
    d = dim.filter(F.col("registro_ans").isNotNull()).select(
        F.col("registro_ans").alias("_key"), "razao_social", "uf")
    # null-safe on keys that are never NULL: the same rows as a plain equality,
    # but no filter is inferred for the fact side, which would make its scan
    # and exchange differ from those of the totals
    named = per_op.join(d, F.col("registro_ans").eqNullSafe(F.col("_key")), "inner").drop("_key")
    ops = top_k(named.select("registro_ans", "razao_social", "total"),
                [desc("total"), asc("registro_ans")], 5)
    states = named.filter(F.col("uf").isNotNull()).groupBy("uf").agg(F.sum("total").alias("total"))
    sts = top_k(states, [desc("total"), asc("uf")], 10)
    return one_row([
        total, mean,
        _ranked_pairs(ops, "razao_social", "total", "top_5_operadoras"),
        _ranked_pairs(sts, "uf", "total", "top_estados"),
    ])


def _ranked_pairs(top: DataFrame, name_col: str, total_col: str, alias: str) -> DataFrame:
    """Bounded top-k rows -> one ordered ``array<struct<nome,total>>``."""
    ranked = top.select(
        F.struct(
            (-F.col(total_col)).alias("_k"),
            F.col(name_col).alias("nome"),
            F.col(total_col).cast("double").alias("total"),
        ).alias("s")
    )
    arr = ranked.agg(F.sort_array(F.collect_list("s")).alias("_a"))
    return arr.select(
        F.transform("_a", lambda s: F.struct(s["nome"].alias("nome"), s["total"].alias("total"))).alias(alias)
    )


def chart_series(fact: DataFrame, dim: DataFrame, k: int = 10) -> DataFrame:
    """Chart inputs (R5): ``labels[]`` and ``values[]`` of the top-k states."""
    st = _ranked_pairs(top_state_totals(fact, dim, k), "uf", "total", "pairs")
    return st.select(
        F.transform("pairs", lambda s: s["nome"]).alias("labels"),
        F.transform("pairs", lambda s: s["total"]).alias("values"),
    )


