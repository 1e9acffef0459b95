"""Every registered query of the library with the SQL that gives the same rows."""

from __future__ import annotations

from .queries import line_queries, more_queries, planted_queries, rest_queries, scale_queries, source_queries, table_queries, text_queries

QUERIES: dict = {**text_queries.QUERIES, **table_queries.QUERIES, **more_queries.QUERIES, **line_queries.QUERIES, **source_queries.QUERIES, **scale_queries.QUERIES, **rest_queries.QUERIES, **planted_queries.QUERIES}
ORACLE_SQL: dict[str, str] = {**text_queries.ORACLE_SQL, **table_queries.ORACLE_SQL, **more_queries.ORACLE_SQL, **line_queries.ORACLE_SQL, **source_queries.ORACLE_SQL, **scale_queries.ORACLE_SQL, **rest_queries.ORACLE_SQL, **planted_queries.ORACLE_SQL}
