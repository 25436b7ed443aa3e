"""Reading tables and publishing results as plain Parquet."""
