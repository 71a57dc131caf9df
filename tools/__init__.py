"""Developer tools: the Spark-vs-DuckDB comparison and the plan dump."""
