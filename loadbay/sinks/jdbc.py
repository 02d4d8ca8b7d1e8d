"""JDBC sinks (K9b, K10-K12, K19): bulk loads through Spark's JDBC writer.

Rows are prepared with Column rules (column mapping P7, set expressions P8,
separator removal P13b, arity P9, date parsing P11) and written by the
executors in batches.  Key policies (IGNORE/REPLACE) run in the database:
the batch lands in a staging table, then one ``INSERT ... SELECT`` moves it.
Statements run on the driver through a plain JDBC connection.
"""

from __future__ import annotations

import re

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.functions import dates as dt
from loadbay.functions import text as tx
from loadbay.sinks.catalog import split_statements

# Batch sizes of the loaders.
BATCH_SIZES = {"mysql": 500, "postgres": 1000, "oracle": 500, "oracle_direct": 50000}


def map_columns(df: DataFrame, colorder: Sequence[str] | str | None = None,
                target_cols: Sequence[str] | None = None) -> DataFrame:
    """The i-th source field becomes the i-th named target column.

    ``colorder="ascii"`` orders the target columns by name; names starting
    with ``@`` are load variables (kept under that name for ``set_exprs`` and
    dropped afterwards); target columns not listed get NULL.  A name absent
    from ``target_cols`` is an error.
    """
    src = df.columns
    if colorder is None:
        names = list(target_cols or src)
    elif isinstance(colorder, str) and colorder.lower() == "ascii":
        names = sorted(target_cols or src)
    else:
        names = list(colorder)
    if target_cols is not None:
        unknown = [n for n in names if not n.startswith("@") and n not in target_cols]
        if unknown:
            raise ValueError(f"unknown target columns {unknown}")
    cols = [F.col(f"`{src[i]}`").alias(n) if i < len(src) else F.lit(None).cast("string").alias(n)
            for i, n in enumerate(names)]
    if target_cols is not None:
        cols += [F.lit(None).cast("string").alias(t) for t in target_cols if t not in names]
    return df.select(cols)


# Quoted text and names stay as they are; ``@name`` outside them is a load variable.
_LOAD_VARS = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|@(\w+)""", re.S)


def _var_column(m: re.Match) -> str:
    return f"__var_{m[1]}" if m[1] else m[0]


def set_exprs(df: DataFrame, sets: str | Mapping[str, str] | None,
              target_cols: Sequence[str] | None = None) -> DataFrame:
    """``"c = expr, d = expr"`` derived columns (may use ``@var``
    columns), then load variables are dropped."""
    if sets:
        if isinstance(sets, str):
            pairs = {}
            for part in _split_top(sets):
                k, v = part.split("=", 1)
                pairs[k.strip()] = v.strip()
        else:
            pairs = dict(sets)
        renamed = df
        for c in df.columns:
            if c.startswith("@"):
                renamed = renamed.withColumnRenamed(c, "__var_" + c[1:])
        exprs = {k: F.expr(_LOAD_VARS.sub(_var_column, v)) for k, v in pairs.items()}
        df = renamed.withColumns(exprs)
        df = df.toDF(*[("@" + c[6:]) if c.startswith("__var_") else c for c in df.columns])
    keep = [c for c in df.columns if not c.startswith("@")]
    if target_cols is not None:
        keep = [c for c in target_cols if c in keep]
    return df.select([F.col(f"`{c}`") for c in keep])


def _split_top(text: str) -> list[str]:
    out, depth, cur, quote = [], 0, [], None
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur))
            cur = []
            continue
        cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur))
    return out


def prepare_rows(df: DataFrame, date_columns: Mapping[str, Sequence[str] | None] | None = None,
                 strip: str = "\x01\x02") -> DataFrame:
    """Text safe for a loader: separators removed (P13b); date columns parsed
    (P11, optional masks per column)."""
    date_columns = date_columns or {}
    cols = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in date_columns:
            masks = date_columns[c]
            col = dt.parse_dates(col.cast("string"), tuple(masks) if masks else None)
        else:
            col = tx.sanitize_load(col.cast("string"), strip)
        cols.append(col.alias(c))
    return df.select(cols)


def _jvm_connection(spark: SparkSession, url: str, props: Mapping[str, str]):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - JDBC statements run in the JVM
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        if k in ("user", "password"):
            jprops.setProperty(k, v)
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, jprops)


def run_jdbc_statements(spark: SparkSession, url: str, text: str | None,
                        props: Mapping[str, str] | None = None) -> int:
    """``;``-separated statements (quote-aware) on one connection."""
    stmts = split_statements(text or "")
    if not stmts:
        return 0
    conn = _jvm_connection(spark, url, props or {})
    try:
        for s in stmts:
            st = conn.createStatement()
            try:
                st.execute(s)
            finally:
                st.close()
    finally:
        conn.close()
    return len(stmts)


def target_columns(spark: SparkSession, url: str, table: str, **props: str) -> list[str]:
    """Column names of a database table (Spark resolves the schema with a
    query that returns no rows)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        r = r.option(k, v)
    return r.load().columns


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batchsize: int = 500, truncate: bool = False, pre: str | None = None,
               post: str | None = None, num_partitions: int | None = None,
               columns_from_table: bool = False, **props: str) -> None:
    """Batched inserts; ``pre`` before, ``post`` only after
    success.  ``truncate=True`` with ``mode="overwrite"`` keeps the table and
    empties it first.  ``columns_from_table`` names the fields by position
    after the target table's own columns (P9 cuts or pads them).  Errors fail
    the job."""
    spark = df.sparkSession
    run_jdbc_statements(spark, url, pre, props)
    if columns_from_table:
        names = target_columns(spark, url, table, **props)
        df = df.select([F.col(f"`{df.columns[i]}`").alias(n) if i < len(df.columns)
                        else F.lit(None).cast("string").alias(n) for i, n in enumerate(names)])
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batchsize)))
    if truncate:
        w = w.option("truncate", "true")
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in props.items():
        w = w.option(k, v)
    w.save()
    run_jdbc_statements(spark, url, post, props)


def write_jdbc_mysql(df: DataFrame, url: str, table: str, key_policy: str = "ignore",
                     staging: str | None = None, **props: str) -> None:
    """Load through a staging table, then ``INSERT IGNORE`` or
    ``REPLACE ... SELECT`` inside the database (one statement, so the
    database applies the key policy atomically)."""
    policy = key_policy.lower()
    if policy not in ("ignore", "replace"):
        raise ValueError(f"unknown policy {key_policy!r}")
    staging = staging or f"{table}__staging"
    cols = ", ".join(f"`{c}`" for c in df.columns)
    verb = "INSERT IGNORE INTO" if policy == "ignore" else "REPLACE INTO"
    write_jdbc(df, url, staging, mode="overwrite", truncate=True,
               batchsize=BATCH_SIZES["mysql"], **props)
    run_jdbc_statements(df.sparkSession, url,
                        f"{verb} {table} ({cols}) SELECT {cols} FROM {staging}", props)


def null_escape_columns(df: DataFrame) -> list[Column]:
    """P14 per column for text loaders (COPY / LOAD DATA)."""
    return [tx.escape_load(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns]


# Oracle date-mask elements and the Spark pattern letters for
# them (longest element first when reading a mask).
ORACLE_MASK_ELEMENTS = [("hh24", "HH"), ("hh12", "hh"), ("month", "MMMM"), ("yyyy", "yyyy"),
                        ("mon", "MMM"), ("mm", "MM"), ("dd", "dd"), ("rr", "RR"), ("yy", "yy"),
                        ("hh", "hh"), ("mi", "mm"), ("ss", "ss"), ("ff", "SSSSSSSSS"),
                        ("am", "a"), ("pm", "a")]
DEFAULT_ORACLE_MASK = "yyyy-mm-dd"

# Text in double quotes, an element, or any one character.
_MASK_PIECES = re.compile(r'"([^"]*)"|(' + "|".join(e for e, _ in ORACLE_MASK_ELEMENTS) + r")|(.)",
                          re.I | re.S)


def oracle_mask_to_spark(mask: str) -> str:
    """An Oracle date mask (``yyyy-mm-dd hh24:mi:ss.ff``) as a pattern of
    ``dates.parse_with``.  An element that is not in the list is an error."""
    letters = dict(ORACLE_MASK_ELEMENTS)
    out = []
    for quoted, element, other in _MASK_PIECES.findall(mask):
        if other.isalpha():
            raise ValueError(f"date mask {mask!r}: unknown element at {other!r}")
        out.append(letters[element.lower()] if element else other or f"'{quoted}'" * bool(quoted))
    return "".join(out)


def positional_date_masks(kinds: Sequence[str], masks: str | None) -> list[str | None]:
    """K12 mask rule: the i-th DATE or TIMESTAMP column takes the i-th mask of
    the comma-separated list (the first mask once the list runs out);
    TIMESTAMP columns take it with ``.ff`` added; default ``yyyy-mm-dd``.
    Other columns get ``None``."""
    listed = [m for m in (masks or "").split(",") if m] or [DEFAULT_ORACLE_MASK]
    out, n = [], 0
    for kind in kinds:
        k = kind.lower()
        if k in ("date", "timestamp"):
            mask = listed[n] if n < len(listed) else listed[0]
            out.append(mask + ".ff" if k == "timestamp" else mask)
            n += 1
        else:
            out.append(None)
    return out


def prepare_rows_with_masks(df: DataFrame, kinds: Sequence[str], masks: str | None = None,
                            strip: str = "\x01\x02") -> DataFrame:
    """Rows for a direct-path style load: DATE/TIMESTAMP columns (by position,
    ``kinds`` from the target table) parsed with their positional mask, other
    columns cleaned of the loader's separators."""
    per_col = positional_date_masks(kinds, masks)
    cols = []
    for c, mask in zip(df.columns, per_col):
        col = F.col(f"`{c}`").cast("string")
        if mask is None:
            cols.append(tx.sanitize_load(col, strip).alias(c))
        else:
            cols.append(dt.parse_with(col, oracle_mask_to_spark(mask)).alias(c))
    return df.select(cols)


# Bulk-load file layouts (field end, line end) per loader.
LOAD_FILE_LAYOUTS = {"mysql": ("\x01", "\x02"), "postgres": ("\x01", "\n")}


def write_load_file(df: DataFrame, path: str, dialect: str = "mysql",
                    mode: str = "overwrite", compression: str | None = None) -> str:
    """The data file a bulk loader reads (``LOAD DATA`` / ``COPY`` text).

    Every field: backslash doubled, the layout's field and line ends removed,
    NULL written as ``\\N`` (P13b/P14).  MySQL: fields end with
    ``\\001``, lines with ``\\002``; PostgreSQL: ``\\001`` and newline."""
    field_end, line_end = LOAD_FILE_LAYOUTS[dialect]
    strip = field_end + line_end
    fields = [tx.escape_load(F.col(f"`{c}`").cast("string"), strip) for c in df.columns]
    lines = df.select(F.concat_ws(field_end, *fields).alias("value"))
    w = lines.write.mode(mode).option("lineSep", line_end)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def read_load_file(spark: SparkSession, path: str, num_fields: int,
                   dialect: str = "mysql") -> DataFrame:
    """Read a bulk-load file back as the loader does: ``\\N`` is NULL and a
    doubled backslash is one backslash."""
    from loadbay.sources.files import read_delimited

    field_end, line_end = LOAD_FILE_LAYOUTS[dialect]
    rows = read_delimited(spark, path, field_split=field_end, null_string="\\N",
                          num_fields=num_fields, line_sep=line_end)
    return rows.select([F.replace(F.col(c), F.lit("\\\\"), F.lit("\\")).alias(c) for c in rows.columns])
