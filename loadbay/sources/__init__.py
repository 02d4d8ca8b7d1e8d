"""Readers: files (delimited, compressed, sequence, Parquet as text, listing,
detection, partitions, remote text), shards, catalog tables and SQL, JDBC,
HTTP bodies and constant rows."""
