"""SQL twins of the registered queries, run by DuckDB as the correctness oracle."""
