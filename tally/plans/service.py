"""The served surface as one object, plus SQL access by table name.

``LedgerService`` answers the four dashboard calls (listing page, operator
detail, expense history, statistics). Methods returning Python values bring
only bounded results to the driver: one page, one operator, top-k lists.
The history of an operator can be arbitrarily long, so it stays a DataFrame
(``history``) and only ``history_page`` collects, one bounded page at a time.

``register_views`` exposes the warehouse tables under their warehouse names
so existing SQL text runs through ``spark.sql`` and the same optimizer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.search_index import SearchIndex
from . import serving

VIEW_NAMES = {"dimension": "operadoras", "fact": "despesas_contabeis",
              "mart": "despesas_agregadas_final"}


def register_views(spark: SparkSession, dim: DataFrame, fact: DataFrame,
                   mart: DataFrame | None = None) -> dict[str, str]:
    """Register the tables as temporary views under their warehouse names.

    ``mart`` is the typed mart (``Warehouse.mart_table``), whose column names
    are those that SQL over that view uses."""
    dim.createOrReplaceTempView(VIEW_NAMES["dimension"])
    fact.createOrReplaceTempView(VIEW_NAMES["fact"])
    if mart is not None:
        mart.createOrReplaceTempView(VIEW_NAMES["mart"])
    return dict(VIEW_NAMES)


def _plain(v):
    if hasattr(v, "asDict"):
        return {k: _plain(x) for k, x in v.asDict().items()}
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return v


@dataclass
class LedgerService:
    dim: DataFrame
    fact: DataFrame
    index: SearchIndex | None = None  # of the dimension's names and tax ids

    def operators(self, page: int = 1, limit: int = 10, search: str | None = None) -> dict:
        """``{data: [...], total, page, limit}`` for one listing page."""
        row = serving.listing(self.dim, search, page, limit, index=self.index).first()
        return _plain(row)

    def operator(self, cnpj: str) -> dict | None:
        """The operator with this tax id, or ``None`` (not found) (R2)."""
        row = serving.operator_detail(self.dim, cnpj).first()
        return None if row is None else _plain(row)

    def history(self, cnpj: str) -> DataFrame:
        """All expense rows of the operator, latest first (R3), as a DataFrame."""
        return serving.expense_history(self.fact, self.dim, cnpj)

    def history_page(self, cnpj: str, page: int = 1, limit: int = 100) -> list[dict]:
        """One bounded page of the history as Python rows."""
        if page < 1 or limit < 1:
            raise ValueError("page and limit must be >= 1")
        rows = self.history(cnpj).offset((page - 1) * limit).limit(limit).collect()
        return [_plain(r) for r in rows]

    def statistics(self) -> dict:
        """Total, mean per operator, top-5 operators, top-10 states."""
        return _plain(serving.statistics(self.fact, self.dim).first())

    def chart(self) -> dict:
        """``labels`` / ``values`` of the top states."""
        return _plain(serving.chart_series(self.fact, self.dim).first())

