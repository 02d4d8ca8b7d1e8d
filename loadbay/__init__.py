"""loadbay — bulk table exchange on Spark.

Sources turn files, catalog tables, JDBC tables and cell tables into
DataFrames of text columns; row rules (NULL markers, separators, escaping,
charsets, dates, column mapping, typing) are plain Column expressions; sinks
write one DataFrame to one or many targets under explicit load policies, and
quality operators report dirty rows, error budgets, reconciliation and
transfer statistics.  Everything is a DataFrame / Spark SQL / Structured
Streaming operation, so the work is partitioned and shuffled by Spark.
"""

from loadbay.session import scratch_path, checkpoint_root, local_session

__all__ = ["scratch_path", "checkpoint_root", "local_session"]
