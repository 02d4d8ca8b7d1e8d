"""Sharded tables (R12): many same-shaped tables read as one data set."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.functions.names import expand_pattern, expand_shards, work_date_macros


def shard_names(tables: str | Sequence[str], work_date=None) -> list[str]:
    """Table list with ``name[00-15]`` ranges, ``{a..b}`` braces and date
    macros expanded (the list is as long as the shard count)."""
    items = [tables] if isinstance(tables, str) else list(tables)
    out: list[str] = []
    for item in items:
        for name in expand_shards(work_date_macros(item, work_date)):
            out.extend(expand_pattern(name))
    return out


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name as a balanced tree, so thousands of shards keep a
    shallow plan."""
    frames = list(frames)
    if not frames:
        raise ValueError("no shards")
    while len(frames) > 1:
        nxt = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
               for i in range(0, len(frames), 2)]
        frames = nxt
    return frames[0]


def read_sharded(spark: SparkSession, reader: Callable[[str], DataFrame],
                 tables: str | Sequence[str], with_shard: bool = False,
                 work_date=None) -> DataFrame:
    """One scan per shard (``reader(name)``), unioned."""
    names = shard_names(tables, work_date)
    frames = []
    for n in names:
        f = reader(n)
        if with_shard:
            f = f.withColumn("_shard", F.lit(n))
        frames.append(f)
    return union_all(frames)


def read_sharded_files(spark: SparkSession, root: str, tables: str | Sequence[str],
                       fmt: str = "parquet", with_shard: bool = False, work_date=None,
                       **options) -> DataFrame:
    """R12 for file-backed shards: all shard folders in *one* scan (a path
    list), the shard name taken from the file path when asked."""
    names = shard_names(tables, work_date)
    paths = [f"{root.rstrip('/')}/{n}" for n in names]
    df = spark.read.format(fmt).options(**options).load(paths)
    if with_shard:
        # The shard folder is the path component right below the root.
        df = df.withColumn("_shard", F.regexp_extract(F.col("_metadata.file_path"),
                                                      r"/([^/]+)/[^/]+$", 1))
    return df
