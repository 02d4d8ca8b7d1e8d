"""Balanced reads planned from file metadata.

An extent is one row group of a Parquet file.  Executors read the footers of the
listed files (no column data), the extents are put in order of (file, place) and
packed into ``n`` chunks of nearly equal size by their running size, and a chunk
is read extent by extent.  So a few large files are spread over all tasks and
many small ones are read together, without a look at a single row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadbay.session import written
from loadbay.sources.files import list_files

#: Files per task when footers are read.
FOOTERS = 64
_EXTENT = "path string, extent int, rows long, bytes long"


def _open(path: str):
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, inner = pafs.FileSystem.from_uri(path)
    return pq.ParquetFile(fs.open_input_file(inner))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _open(path) as file:
                meta = file.metadata
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                columns = ([path] * len(groups), range(len(groups)), [g.num_rows for g in groups],
                           [g.total_byte_size for g in groups])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                names=["path", "extent", "rows", "bytes"])


def file_extents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """path, extent, rows, bytes of every row group of the Parquet files at ``path``."""
    listed = list_files(spark, path, "*.parquet").select("path")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    listed = written(listed.where(~name.startswith("_") & ~name.startswith(".")), "extent-files")
    tasks = max(1, -(-listed.count() // FOOTERS))
    return listed.repartition(tasks, "path").mapInArrow(_footers, _EXTENT)


def extent_chunks(extents: DataFrame, n: int) -> DataFrame:
    """Adds ``chunk`` (0 to n - 1, rising with (path, extent)): the n-th part of
    the whole size in which an extent's middle lies, so a chunk's size is within
    one extent of an equal share.

    The extents are dealt by range; one number per task gives each task its
    start, so no task sees them all."""
    dealt = written(extents.repartitionByRange("path", "extent")
                    .withColumn("_task", F.spark_partition_id()), "extents")
    sums = dealt.groupBy("_task").agg(F.sum("bytes").alias("_sum"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    starts = sums.select("_task", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
                         F.sum("_sum").over(Window.partitionBy()).alias("_whole"))
    inside = Window.partitionBy("_task").orderBy("path", "extent").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(starts, "_task")
    middle = F.col("_start") + F.col("_inside") + F.col("bytes") / 2
    chunk = F.least(F.floor(middle * n / F.greatest(F.col("_whole"), F.lit(1))), F.lit(n - 1)).cast("int")
    return placed.select(*extents.columns, chunk.alias("chunk"))


def _extent_rows(names: list[str]):
    """path, extent, chunk -> the rows with their chunk.

    A footer describes every row group of its file, so a file is opened once
    for its extents in a row, not once per extent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in range(3))))
        for (where, chunk), same in groupby(listed, lambda row: (row[0], row[2])):
            with _open(where) as file:
                for part in file.iter_batches(row_groups=[extent for _, extent, _ in same], columns=names):
                    part = part.select(names)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array([chunk] * part.num_rows, pa.int32())], names=[*names, "chunk"])
    return run


def read_extents(spark: SparkSession, chunks: DataFrame, path: str | Sequence[str], n: int,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of the extents, one task per chunk (extents in order), with
    their ``chunk``; ``columns`` limits what is read."""
    schema = spark.read.parquet(*([path] if isinstance(path, str) else path)).schema
    names = list(columns) if columns else schema.names
    ddl = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in names)
    return (chunks.select("path", "extent", "chunk").repartition(n, "chunk").sortWithinPartitions("chunk", "path", "extent")
            .mapInArrow(_extent_rows(names), f"{ddl}, chunk int"))
