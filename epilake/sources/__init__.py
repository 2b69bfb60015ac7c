"""Sources and sinks: CSV/Parquet files, partitioned publish, keyed
upsert, table contracts, catalog registration, JDBC."""
