"""All registered queries and oracles."""

from ticketlake.plans import stream_queries  # noqa: F401  (registers the streaming queries)
from ticketlake.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
