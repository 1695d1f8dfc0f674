"""Relational operators: joins, aggregates, first/last, ordering, sets,
filters and data quality. Each is a DataFrame -> DataFrame function."""

from . import aggregates, filters, joins, ordering, quality, sets, windows  # noqa: F401
