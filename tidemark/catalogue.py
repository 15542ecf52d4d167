"""All registered queries of the library outside the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import growth_queries, interval_queries, more_queries, relational_queries, session_queries, signal_queries, sorting_queries, stream_queries, unit_queries
from .plans.flagship import flagship

_PARTS = (interval_queries, relational_queries, signal_queries, unit_queries, more_queries, session_queries, sorting_queries, stream_queries, growth_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for p in _PARTS for k, f in p.QUERIES.items()}
ORACLES: dict[str, str] = {k: s for p in _PARTS for k, s in p.ORACLES.items()}
QUERIES["flagship"] = flagship
