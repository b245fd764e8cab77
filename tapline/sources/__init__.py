"""Sources: SQL over registered tables, JDBC queries, name normalisation and row caps."""

from .query import (
    DEFAULT_FETCH_SIZE,
    cap_rows,
    jdbc_source,
    normalize_columns,
    query_source,
    register_paths,
    register_tables,
    sql_text,
)

__all__ = ["DEFAULT_FETCH_SIZE", "cap_rows", "jdbc_source", "normalize_columns", "query_source",
           "register_paths", "register_tables", "sql_text"]
