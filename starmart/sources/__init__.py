"""Sources and sinks: CSV ingest, Parquet tables, snapshots, partitioned layouts."""
