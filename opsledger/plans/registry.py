"""Registered queries: name -> (spark, folder) -> DataFrame, and their oracles.

Each query is one operator (or a small composition) over the whole input
tables.  Outputs pass through :func:`round_doubles` so doubles compare at a
fixed number of places and integers are bigint, matching the oracle's
``typed`` projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.semantics import round_doubles
from .context import Context

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(ctx) -> DataFrame`` under ``name`` with an optional oracle."""

    def wrap(fn: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return round_doubles(fn(Context(spark, folder)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


def load_all() -> None:
    """Import every query module (each registers itself)."""
    from . import q_marts  # noqa: F401
    from . import q_sql  # noqa: F401
    from . import q_quality  # noqa: F401
    from . import q_analysis  # noqa: F401
    from . import q_decisions  # noqa: F401
    from . import q_promotions  # noqa: F401
    from . import q_planning  # noqa: F401
    from . import q_actions  # noqa: F401
    from . import q_forecast  # noqa: F401
    from . import q_bundle  # noqa: F401
    from . import q_feeds  # noqa: F401
    from . import q_catalog  # noqa: F401
