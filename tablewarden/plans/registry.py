"""All queries and their SQL."""

from __future__ import annotations

from tablewarden.plans import catalog_queries, lineage_queries, record_queries, run_queries

_SETS = (record_queries, catalog_queries, lineage_queries, run_queries)

QUERIES = {name: query for part in _SETS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _SETS for name, sql in part.ORACLES.items()}
