"""Sources and sinks: schema-bound CSV, parameter files, parquet tables."""
