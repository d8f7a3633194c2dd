"""The registered queries."""

from modelwatch.catalog import q_closed, q_edges, q_models, q_monitoring, q_sources, q_tables  # noqa: F401
from modelwatch.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
