"""Cell tables stored as region files.

Cells are dealt by row-key range and sorted inside (row key, family, qualifier,
newest first), one or more files per range; the manifest holds the first and last
row key of every file.  A scan of ``[start, stop)`` opens only the files whose
range it meets.  Loading without clearing (``del_mode`` 0) adds files whose
ranges overlap the older ones; ``compact_regions`` merges them into one set of
ranges again and keeps the newest versions of each cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadbay.operators.cells import CELL_DEL_MODES, CELL_SCHEMA, key_range_filter
from loadbay.sinks import manifest as mf

KEY = "rowkey"
ORDER = ("rowkey", "family", "qualifier", "ts")
COLUMNS = ("rowkey", "family", "qualifier", "ts", "value")


def _cells(cells: DataFrame) -> DataFrame:
    types = dict(part.split() for part in CELL_SCHEMA.split(", "))
    return cells.select(*[F.col(c).cast(types[c]).alias(c) for c in COLUMNS]).where("rowkey is not null")


def write_regions(cells: DataFrame, root: str, del_mode: int = 1, regions: int | None = None) -> mf.Version:
    """Load cells into region files; 0 keeps what is there, 1 and 2 clear
    it.  Cells without a row key are not written.  Readers see the table as it
    was until the load is published."""
    if del_mode not in CELL_DEL_MODES:
        raise ValueError(f"unknown del_mode {del_mode!r}")
    spark = cells.sparkSession
    cells = _cells(cells)
    before = mf.current(spark, root)
    new = mf.add_files(cells, root, KEY, ORDER, regions)
    if CELL_DEL_MODES[del_mode] == "append" and before.number:
        new = mf.files(spark, before).unionByName(new)
    return mf.publish(spark, before, new, KEY, cells.schema)


def region_index(spark: SparkSession, root: str) -> DataFrame:
    """file, lo, hi (first and last row key), rows of every region file."""
    return mf.files(spark, mf.current(spark, root)).select("file", mf.LO, mf.HI, mf.ROWS)


def region_scan(spark: SparkSession, root: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """The cells with row keys in ``[start, stop)``, from the files whose
    range meets it."""
    if start is not None and stop is not None and start > stop:
        raise ValueError("start key is after stop key")
    version = mf.current(spark, root)
    if not version.number:
        raise FileNotFoundError(f"no cells were loaded into {root}")
    return key_range_filter(mf.read_files(spark, version, mf.files_in_range(spark, version, start, stop)),
                            KEY, start, stop)


def compact_regions(spark: SparkSession, root: str, versions: int = 1, regions: int | None = None) -> mf.Version:
    """Rewrite the table as one set of ranges with the ``versions`` newest
    versions of each cell (largest ``ts``; a missing one is the oldest, equal
    ones by value).

    The newest versions are picked per task before they are shuffled, so a cell
    with very many versions costs each task ``versions`` rows."""
    before = mf.current(spark, root)
    if not before.number:
        raise FileNotFoundError(f"no cells were loaded into {root}")
    cells = mf.read_files(spark, before)
    cell = ["rowkey", "family", "qualifier"]
    newest = Window.partitionBy(*cell).orderBy(F.col("ts").desc_nulls_last(), F.col("value").desc_nulls_last())
    kept = cells.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= versions).drop("_nth")
    new = mf.add_files(kept, root, KEY, ORDER, regions)
    return mf.publish(spark, before, new, KEY, cells.schema)
