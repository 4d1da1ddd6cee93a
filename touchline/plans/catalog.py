"""All registered queries of the match operators and their SQL oracles."""

from __future__ import annotations

from touchline.plans import master_queries, text_queries, view_queries  # noqa: F401  they register their queries
from touchline.plans.match_queries import ORACLE, QUERIES


__all__ = ["ORACLE", "QUERIES"]
