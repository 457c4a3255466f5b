"""Importing the modules registers their queries."""

from suite import harvest_queries, record_queries, table_queries, text_queries, value_queries  # noqa: F401
from suite.registry import ORACLES, QUERIES  # noqa: F401
