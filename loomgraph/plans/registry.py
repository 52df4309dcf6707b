"""All queries of the library and their DuckDB SQL."""

from __future__ import annotations

from loomgraph.plans import document_queries, graph_queries, serving_queries

QUERIES = document_queries.QUERIES | graph_queries.QUERIES | serving_queries.QUERIES
ORACLE_SQL = document_queries.ORACLE_SQL | graph_queries.ORACLE_SQL | serving_queries.ORACLE_SQL
