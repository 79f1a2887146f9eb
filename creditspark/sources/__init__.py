"""Sources and sinks: Parquet tables, the loan tape, macro tables, JSON-lines specs, CSV/Parquet sinks."""
