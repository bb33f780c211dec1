"""Sources and sinks: driver parquet tables, encounter records, CSV ingest, guarded appends."""
