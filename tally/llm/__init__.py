"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage; the registered queries
(`queries.py`) are added by the driver entry only where it can be imported.
"""
