"""JDBC sources (R10a-d, R11, R13): tables, user SQL and key-range reads.

Each dialect is a set of connection defaults; the scan itself is Spark's
JDBC source, parallel through ``predicates`` (one partition per key range).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from loadbay.functions.names import expand_shards
from loadbay.operators.ranges import chunk_predicates

# Per-database defaults of the readers.
DIALECTS: dict[str, dict[str, object]] = {
    "mysql": {
        "driver": "com.mysql.jdbc.Driver",
        "port": 3306,
        "url": "jdbc:mysql://{host}:{port}/{db}?zeroDateTimeBehavior=convertToNull"
               "&yearIsDateType=false&useCursorFetch=true",
        # Rows arrive in bounded batches through a server cursor (the
        # memory-bounded equivalent of the driver's row streaming).
        "fetchsize": "1000",
    },
    "postgres": {
        "driver": "org.postgresql.Driver",
        "port": 5432,
        "url": "jdbc:postgresql://{host}:{port}/{db}",
        "fetchsize": "1000",
    },
    "oracle": {
        "driver": "oracle.jdbc.OracleDriver",
        "port": 1521,
        "url": "jdbc:oracle:thin:@{host}:{port}:{db}",
        "fetchsize": "500",
    },
    "sqlserver": {
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "port": 1433,
        "url": "jdbc:sqlserver://{host}:{port};databaseName={db}",
        "fetchsize": "1000",
    },
}


def jdbc_url(dialect: str, host: str, db: str, port: int | None = None) -> str:
    d = DIALECTS[dialect]
    return str(d["url"]).format(host=host, port=port or d["port"], db=db)


def table_sql(table: str, columns: str | Sequence[str] = "*", where: str | None = None,
              schema: str | None = None) -> str:
    """``select <columns> from [schema.]<table> [where ...]``."""
    cols = columns if isinstance(columns, str) else ", ".join(columns)
    name = f"{schema}.{table}" if schema else table
    q = f"SELECT {cols or '*'} FROM {name}"
    if where:
        q += f" WHERE {where}"
    return q


def clean_sql(sql: str) -> str:
    """User SQL as shipped: surrounding blanks and trailing ``;`` dropped."""
    return sql.strip().rstrip(";").strip()


def _reader(spark: SparkSession, url: str, dialect: str | None, props: Mapping[str, str]):
    r = spark.read.format("jdbc").option("url", url)
    if dialect:
        d = DIALECTS[dialect]
        r = r.option("fetchsize", str(d["fetchsize"]))
        if "driver" not in props:
            r = r.option("driver", str(d["driver"]))
    for k, v in props.items():
        r = r.option(k, v)
    return r


def read_jdbc_table(spark: SparkSession, url: str, table: str, dialect: str | None = None,
                    columns: str | Sequence[str] = "*", where: str | None = None,
                    schema: str | None = None, **props: str) -> DataFrame:
    """R10a-d: one table (``columns`` and ``where`` are pushed to the
    database as part of its query)."""
    q = table_sql(table, columns, where, schema)
    return _reader(spark, url, dialect, props).option("query", q).load()


def read_jdbc_query(spark: SparkSession, url: str, sql: str, dialect: str | None = None,
                    **props: str) -> DataFrame:
    """The user's SQL runs in the database (not split)."""
    return _reader(spark, url, dialect, props).option("query", clean_sql(sql)).load()


def read_jdbc_sharded(spark: SparkSession, url: str, tables: str, dialect: str | None = None,
                      columns: str | Sequence[str] = "*", where: str | None = None,
                      **props: str) -> DataFrame:
    """R12 over JDBC: ``t_[00-15]`` -> one query per shard, unioned."""
    from loadbay.sources.shards import union_all

    return union_all([read_jdbc_table(spark, url, t, dialect, columns, where, **props)
                      for t in expand_shards(tables)])


def ntile_bounds_sql(table: str, key: str, n: int = 200, where: str | None = None) -> str:
    """Database-side NTILE(n) bounds: the database ranks its own rows and
    returns ``n`` (lo, hi) pairs."""
    w = f" WHERE {where}" if where else ""
    return (f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM "
            f"(SELECT {key}, NTILE({n}) OVER (ORDER BY {key}) AS g FROM {table}{w}) t "
            f"GROUP BY g ORDER BY g")


def read_jdbc_chunked(spark: SparkSession, url: str, table: str, key: str, n: int = 200,
                      dialect: str | None = None, where: str | None = None,
                      columns: str | Sequence[str] = "*", **props: str) -> DataFrame:
    """Read a big table as ``n`` key ranges in parallel.

    The bounds query returns at most ``n`` rows (a fixed bound, so taking
    them to the driver is safe); each range becomes one JDBC predicate,
    AND-ed with ``where``.  No rows -> one full read.
    """
    bounds_df = read_jdbc_query(spark, url, ntile_bounds_sql(table, key, n, where), dialect, **props)
    bounds = [(r[0], r[1]) for r in bounds_df.collect()]
    preds = chunk_predicates(bounds, key, where)
    cols = columns if isinstance(columns, str) else ", ".join(columns)
    props = dict(props)
    if dialect:
        props.setdefault("driver", str(DIALECTS[dialect]["driver"]))
        props.setdefault("fetchsize", str(DIALECTS[dialect]["fetchsize"]))
    df = spark.read.jdbc(url, table, predicates=preds, properties=props)
    return df if cols.strip() == "*" else df.selectExpr(*[c.strip() for c in cols.split(",")])
