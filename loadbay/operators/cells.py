"""Wide-column cell tables.

A cell table is ``(rowkey, family, qualifier, ts, value)``, one row per cell
version, as a wide-column store keeps it.  Rows become cells with one
``explode`` (no shuffle); cells become rows with one aggregate on the row
key whose map-side partial aggregation keeps a hot row key cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_SCHEMA = "rowkey string, family string, qualifier string, ts bigint, value string"


def split_column_name(name: str) -> tuple[str, str]:
    """``"cf:q"`` -> ``("cf", "q")``; a name without ``:`` is an error."""
    if ":" not in name:
        raise ValueError(f"column {name!r} is not family:qualifier")
    fam, qual = name.split(":", 1)
    return fam, qual


# --------------------------------------------------------------------------
# Rows -> cells
# --------------------------------------------------------------------------

def rows_to_cells(df: DataFrame, rowkey_index: int, columns: Sequence[str],
                  value_index: Sequence[int] | None = None,
                  ts: Column | int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(cells, dirty)`` from positional rows.

    Field ``rowkey_index`` is the row key; ``columns[i]`` (``family:qualifier``)
    names the cell of value field ``value_index[i]`` (default: every field but
    the key, in order).  A NULL row key makes the row dirty; a row with at
    most one field is skipped; a NULL cell is not written.
    """
    names = df.columns
    if value_index is None:
        value_index = [i for i in range(len(names)) if i != rowkey_index]
    if len(columns) != len(value_index):
        raise ValueError("columns and value fields do not pair up")
    key = F.col(f"`{names[rowkey_index]}`").cast("string")
    if ts is None:
        ts_col = F.lit(None).cast("bigint")
    elif isinstance(ts, int):
        ts_col = F.lit(ts).cast("bigint")
    else:
        ts_col = ts.cast("bigint")
    entries = []
    for name, idx in zip(columns, value_index):
        fam, qual = split_column_name(name)
        v = F.col(f"`{names[idx]}`").cast("string")
        entries.append(F.struct(F.lit(fam).alias("family"), F.lit(qual).alias("qualifier"),
                                v.alias("value")))
    if len(names) <= 1:
        # A row of at most one field carries no cell: skipped, not dirty.
        return df.sparkSession.createDataFrame([], CELL_SCHEMA), df.limit(0)
    dirty = df.filter(key.isNull())
    cells = (df.filter(key.isNotNull())
             .select(key.alias("rowkey"), ts_col.alias("ts"), F.explode(F.array(*entries)).alias("c"))
             .filter(F.col("c.value").isNotNull())
             .select("rowkey", F.col("c.family").alias("family"), F.col("c.qualifier").alias("qualifier"),
                     "ts", F.col("c.value").alias("value")))
    return cells, dirty


# --------------------------------------------------------------------------
# Cells -> rows, key ranges
# --------------------------------------------------------------------------

def key_range_filter(df: DataFrame, key: str, start: str | None = None,
                     stop: str | None = None) -> DataFrame:
    """Half-open ``[start, stop)`` on a text key (``None`` = open end).

    Text comparison in Spark is UTF-8 byte order, the order of the store.
    """
    if start is not None and stop is not None and start > stop:
        raise ValueError("start key is after stop key")
    out = df
    if start is not None:
        out = out.filter(F.col(key) >= F.lit(start))
    if stop is not None:
        out = out.filter(F.col(key) < F.lit(stop))
    return out


def clip_ranges(ranges: DataFrame, start: str | None = None, stop: str | None = None,
                start_col: str = "start", stop_col: str = "stop") -> DataFrame:
    """Intersect region ranges (NULL = unbounded) with ``[start, stop)``;
    empty intersections are dropped."""
    if start is not None and stop is not None and start > stop:
        raise ValueError("start key is after stop key")
    s = F.greatest(F.col(start_col), F.lit(start).cast("string")) if start is not None else F.col(start_col)
    e = F.least(F.col(stop_col), F.lit(stop).cast("string")) if stop is not None else F.col(stop_col)
    clipped = ranges.select("*", s.alias("clip_start"), e.alias("clip_stop"))
    return clipped.filter(F.col("clip_start").isNull() | F.col("clip_stop").isNull()
                          | (F.col("clip_start") < F.col("clip_stop")))


def cells_to_rows(cells: DataFrame, columns: Sequence[str], start: str | None = None,
                  stop: str | None = None, keep_key: bool = False) -> DataFrame:
    """Chosen ``family:qualifier`` cells -> one row per row key.

    The newest version (largest ``ts``) of each cell wins; a missing cell is
    NULL; row keys with none of the chosen cells give no row; the row key is
    not an output field unless ``keep_key``.  Fields are ``_c0..`` in the
    order of ``columns``.
    """
    pairs = [split_column_name(c) for c in columns]
    chosen = None
    for fam, qual in pairs:
        term = (F.col("family") == F.lit(fam)) & (F.col("qualifier") == F.lit(qual))
        chosen = term if chosen is None else (chosen | term)
    picked = key_range_filter(cells, "rowkey", start, stop).filter(chosen)
    aggs = []
    for i, (fam, qual) in enumerate(pairs):
        is_it = (F.col("family") == F.lit(fam)) & (F.col("qualifier") == F.lit(qual))
        # Newest version; among equal versions the larger value, so the pick
        # does not depend on row order.
        order = F.when(is_it, F.struct(F.col("ts"), F.col("value")))
        aggs.append(F.max_by(F.col("value"), order).alias(f"_c{i}"))
    rows = picked.groupBy("rowkey").agg(*aggs)
    return rows if keep_key else rows.drop("rowkey")


# --------------------------------------------------------------------------
# Loading cells
# --------------------------------------------------------------------------

# del_mode of the cell writer; 1 (truncate) is the default.
CELL_DEL_MODES = {0: "append", 1: "overwrite", 2: "overwrite"}


def write_cells(cells: DataFrame, path: str, del_mode: int = 1) -> str:
    """Keep (0, append: newest ``ts`` wins on read), truncate (1) or
    delete all rows (2) before loading the cell table at ``path``."""
    if del_mode not in CELL_DEL_MODES:
        raise ValueError(f"unknown del_mode {del_mode!r}")
    cells.select("rowkey", "family", "qualifier", "ts", "value") \
        .write.mode(CELL_DEL_MODES[del_mode]).parquet(path)
    return path
