"""Writers: files (text, compressed, sequence, typed Parquet, CSV, console,
schema sidecar), catalog partition loads and statements, JDBC loads and
bulk-load data files."""
