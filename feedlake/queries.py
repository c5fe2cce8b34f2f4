"""Registry of the library's own queries and their SQL."""

from __future__ import annotations

from feedlake.plans import delivery_queries, feed_queries, governance_queries, sheet_queries

_PARTS = (sheet_queries, feed_queries, delivery_queries, governance_queries)
QUERIES: dict = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
ORACLES: dict = {k: v for p in _PARTS for k, v in p.ORACLES.items()}
