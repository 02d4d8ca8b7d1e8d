"""Catalog sources (R8, R9): tables by name, and the user's own SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.functions import text as tx
from loadbay.sinks.catalog import FIELD_SPLIT


def warehouse_location(db: str, table: str, warehouse: str) -> str:
    """Folder of a managed table: ``<warehouse>/<db>.db/<table>``, or
    ``<warehouse>/<table>`` in the default database."""
    base = warehouse.rstrip("/")
    if db in ("", "default", None):
        return f"{base}/{table}"
    return f"{base}/{db}.db/{table}"


def read_hive_location(spark: SparkSession, db: str, table: str,
                       partition: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table; a partition spec becomes a filter that Spark
    turns into partition pruning.

    A text table that ``load_hive`` made without a Hive catalog is read from
    its files by the rules of R1, so every character of a field comes back."""
    name = table if db in ("", None) else f"{db}.{table}"
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    df = spark.table(name)
    if FIELD_SPLIT in props:
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        fields = [c for c in df.columns if c not in parts]
        where = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
                 if r["col_name"] == "Location"][0]
        schema = ", ".join(f"`{c}` string" for c in ["value", *parts])
        lines = spark.read.schema(schema).text(where)
        split = tx.null_map_fields(tx.split_line("value", props[FIELD_SPLIT]), "\\N")
        df = lines.select(*[c.alias(f) for c, f in zip(tx.fields_to_columns(split, len(fields)), fields)],
                          *[F.col(f"`{p}`") for p in parts])
    for k, v in (partition or {}).items():
        df = df.filter(F.col(k) == F.lit(v))
    return df


def read_query(spark: SparkSession, sql: str | None = None, tables: str | None = None,
               columns: str = "*", where: str | None = None) -> DataFrame:
    """The user's SQL (wins when given), else ``select columns from
    tables [where ...]``; trailing ``;`` is dropped."""
    if sql:
        return spark.sql(sql.strip().rstrip(";"))
    if not tables:
        raise ValueError("sql or tables is needed")
    q = f"SELECT {columns or '*'} FROM {tables}"
    if where:
        q += f" WHERE {where}"
    return spark.sql(q)
