"""Catalog sinks (K7, K8, K19): partition loads, shard routing, statements."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.functions.text import sanitize_hdfs
from loadbay.functions.names import route_shard_name

# File type of the writer -> table storage.
HIVE_STORAGE = {"TXT": "TEXTFILE", "SEQ": "SEQUENCEFILE", "PARQUET": "PARQUET"}
# Without a Hive catalog: the data source that stores the same files.
SPARK_STORAGE = {"TXT": "csv", "PARQUET": "parquet"}

# Property of a text table without a Hive catalog: what separates its fields.
FIELD_SPLIT = "loadbay.field_split"

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def has_hive_catalog(spark: SparkSession) -> bool:
    try:
        return spark.conf.get("spark.sql.catalogImplementation") == "hive"
    except Exception:  # noqa: BLE001
        return False


def split_statements(text: str) -> list[str]:
    """``;``-separated statements; a ``;`` inside quotes does not split."""
    out, cur, quote = [], [], None
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
        elif ch in ("'", '"', "`"):
            quote = ch
            cur.append(ch)
        elif ch == ";":
            stmt = "".join(cur).strip()
            if stmt:
                out.append(stmt)
            cur = []
        else:
            cur.append(ch)
    stmt = "".join(cur).strip()
    if stmt:
        out.append(stmt)
    return out


def run_statements(spark: SparkSession, text: str | None) -> int:
    """K19 for catalog tables: run ``pre``/``post`` statements in order."""
    n = 0
    for stmt in split_statements(text or ""):
        spark.sql(stmt)
        n += 1
    return n


def load_hive(df: DataFrame, table: str, partition: Mapping[str, str] | None = None,
              file_type: str = "TXT", field_split: str = "\x01", location: str | None = None,
              pre: str | None = None, post: str | None = None) -> str:
    """K7: create an all-text table if missing, then append a partition.

    Columns are created as STRING, partition columns too.  With a Hive
    catalog the table is ``STORED AS`` TEXTFILE / SEQUENCEFILE / PARQUET;
    otherwise it is a Spark data source table over the same kind of files
    (``\\001``-separated text or Parquet).  ``post`` runs only after success.

    In text files only the separator and line ends are replaced; blanks,
    quotes and backslashes stay.  NULL is written as ``\\N``, so a field that
    is this text reads as NULL, as in any Hive text table.  ``read_hive_location``
    gives empty text back as empty text; Spark's own reader of such a table
    shows it as NULL.
    """
    spark = df.sparkSession
    partition = dict(partition or {})
    run_statements(spark, pre)
    cols = [c for c in df.columns if c not in partition]
    col_ddl = ", ".join(f"{_ident(c)} STRING" for c in cols)
    part_ddl = ", ".join(f"{_ident(p)} STRING" for p in partition)
    ft = file_type.upper()
    loc = f" LOCATION '{location}'" if location else ""
    if has_hive_catalog(spark):
        part = f" PARTITIONED BY ({part_ddl})" if partition else ""
        fmt = f" ROW FORMAT DELIMITED FIELDS TERMINATED BY '{_sql_char(field_split)}'" if ft == "TXT" else ""
        ddl = f"CREATE TABLE IF NOT EXISTS {table} ({col_ddl}){part}{fmt} STORED AS {HIVE_STORAGE[ft]}{loc}"
    else:
        if ft not in SPARK_STORAGE:
            raise ValueError(f"file type {file_type} needs a Hive catalog")
        all_cols = ", ".join([f"{_ident(c)} STRING" for c in cols] +
                             [f"{_ident(p)} STRING" for p in partition])
        part = f" PARTITIONED BY ({', '.join(_ident(p) for p in partition)})" if partition else ""
        opts = props = ""
        if ft == "TXT":
            opts = (f" OPTIONS (sep '{_sql_char(field_split)}', quote '', escape '', nullValue '\\\\N', emptyValue '', "
                    "ignoreLeadingWhiteSpace 'false', ignoreTrailingWhiteSpace 'false')")
            props = f" TBLPROPERTIES ('{FIELD_SPLIT}' = '{_sql_char(field_split)}')"
        ddl = f"CREATE TABLE IF NOT EXISTS {table} ({all_cols}) USING {SPARK_STORAGE[ft]}{opts}{part}{loc}{props}"
    spark.sql(ddl)
    # A static partition insert: the partition values are part of the
    # statement, so no dynamic-partition mode is needed in either catalog.
    view = f"loadbay_load_{uuid.uuid4().hex[:12]}"
    texts = [F.col(f"`{c}`").cast("string") for c in cols]
    if ft == "TXT":  # a field may not hold what ends fields and lines
        texts = [sanitize_hdfs(t, field_split, "\n") for t in texts]
    df.select([t.alias(c) for t, c in zip(texts, cols)]).createOrReplaceTempView(view)
    try:
        spec = ", ".join(f"{_ident(k)} = '{_sql_value(v)}'" for k, v in partition.items())
        part_clause = f" PARTITION ({spec})" if partition else ""
        select_cols = ", ".join(_ident(c) for c in cols)
        spark.sql(f"INSERT INTO {table}{part_clause} SELECT {select_cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    run_statements(spark, post)
    return table


def _sql_value(v) -> str:
    return str(v).replace("\\", "\\\\").replace("'", "\\'")


def _sql_char(ch: str) -> str:
    if ch == "\x01":
        return "\\u0001"
    if ch == "\t":
        return "\\t"
    return ch.replace("'", "\\'")


def route_shards(df: DataFrame, name_col: str, dir_: str, fmt: str = "parquet",
                 mode: str = "overwrite", target_col: str = "target") -> str:
    """K8: target per row from its source table name, one folder per target
    (``target=s_orders``).

    Rows are rebalanced by target first: a small target is one file, a large
    one as many as its size asks for (the adaptive advisory size), instead of
    one file per task and target."""
    routed = df.withColumn(target_col, route_shard_name(F.col(name_col)))
    routed.hint("rebalance", F.col(target_col)).write.mode(mode).partitionBy(target_col).format(fmt).save(dir_)
    return dir_


def write_partitioned(df: DataFrame, dir_: str, names: Sequence[str], fmt: str = "text",
                      mode: str = "overwrite") -> str:
    """Write ``name=value`` partition folders (the layout R7 reads), rows
    rebalanced by folder as in ``route_shards``."""
    df.hint("rebalance", *[F.col(n) for n in names]).write.mode(mode).partitionBy(*names).format(fmt).save(dir_)
    return dir_
