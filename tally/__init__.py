"""Ledger analytics on Spark: sources, functions, operators, plans, sinks, streaming.

Common entry points::

    from tally import build_session, build_warehouse, LedgerService, register_views
"""

from .plans.batch import build_warehouse
from .plans.service import LedgerService, register_views
from .session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir", "build_warehouse", "LedgerService",
           "register_views"]
