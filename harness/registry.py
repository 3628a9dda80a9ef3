"""All registered queries and oracle statements."""

from __future__ import annotations

from harness import load_queries, report_queries, statement_queries

_PARTS = (report_queries, statement_queries, load_queries)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
