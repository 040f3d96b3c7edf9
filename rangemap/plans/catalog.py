"""All queries of the library's own operators, and their SQL."""

from __future__ import annotations

from . import field_queries, io_queries, jobs, queries, shape_queries

QUERIES = queries.QUERIES | io_queries.QUERIES | shape_queries.QUERIES | field_queries.QUERIES | jobs.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | io_queries.ORACLE_SQL | shape_queries.ORACLE_SQL | field_queries.ORACLE_SQL | jobs.ORACLE_SQL
