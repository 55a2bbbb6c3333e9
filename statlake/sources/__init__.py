"""Sources and sinks: parquet tables, '~'-separated CSV files, generators."""
