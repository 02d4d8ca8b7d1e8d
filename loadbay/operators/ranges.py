"""Key ranges for parallel reads.

``key_range_chunks`` is NTILE(n) over a key with exact group sizes, computed
without a window over the whole table: the key column alone is range
partitioned and sorted inside each partition, a per-partition count table
(one row per partition) gives each partition's offset, and every row's global
rank is offset + position.  Only the key column is shuffled; the offset table
is as small as the partition count, so broadcasting it is safe at any scale.
"""

from __future__ import annotations

import itertools
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PART_BITS = 2 ** 33  # monotonically_increasing_id = partition << 33 | row


def global_rank(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """``(key, rank, total)`` with ``rank`` 0-based in key order.

    Equal keys are ordered by a tie-breaker (the row's position in the
    input), so the range partitioning can split a run of equal keys: a key
    holding a third of all rows is spread over many partitions instead of
    landing in one task.
    """
    spark = df.sparkSession
    if num_partitions is None:
        # Enough range partitions for every task slot twice over, so
        # each sorted run stays small; the offset table grows only with this
        # number (a few bytes per partition).
        num_partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                             2 * spark.sparkContext.defaultParallelism)
    order = [F.col("_k").asc_nulls_first(), F.col("_t").asc()]
    ranged = (df.select(F.col(key).alias("_k"), F.monotonically_increasing_id().alias("_t"))
              .repartitionByRange(num_partitions, *order)
              .sortWithinPartitions(*order)
              .select("_k",
                      F.spark_partition_id().alias("_p"),
                      (F.monotonically_increasing_id()
                       - F.spark_partition_id().cast("bigint") * F.lit(_PART_BITS)).alias("_i")))
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: an un-partitioned window is fine here.
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_total"))
    return (ranged.join(F.broadcast(offsets), "_p")
            .select(F.col("_k").alias(key), (F.col("_off") + F.col("_i")).alias("_rank"),
                    F.col("_total")))


def ntile_of(rank: Column, total: Column, n: int) -> Column:
    """0-based NTILE group of a 0-based rank: the first ``total % n`` groups
    hold one row more than the others."""
    q = F.floor(total / F.lit(n)).cast("bigint")
    rem = (total - q * F.lit(n)).cast("bigint")
    big = q + 1
    head = rem * big
    return F.when(rank < head, F.floor(rank / big)).otherwise(
        rem + F.floor((rank - head) / F.when(q > 0, q).otherwise(F.lit(1)))).cast("int")


def key_range_chunks(df: DataFrame, key: str, n: int = 200,
                     num_partitions: int | None = None) -> DataFrame:
    """``(chunk, lo, hi, rows)`` for NTILE(n) over ``key``.

    Chunk ``i`` covers keys ``lo <= key <= hi``; reading every chunk reads
    every row exactly once.  An empty input gives no chunks (one full read).
    """
    ranked = global_rank(df, key, num_partitions)
    g = ntile_of(F.col("_rank"), F.col("_total"), n)
    return (ranked.groupBy(g.alias("chunk"))
            .agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
                 F.count(F.lit(1)).alias("rows")))


def chunk_predicates(bounds: list[tuple], key: str, where: str | None = None) -> list[str]:
    """SQL predicates, one per chunk, AND-ed with the user's ``where``.

    Chunks are half-open between consecutive lower bounds (the first is open
    below and also takes NULL keys, the last is open above), so every row is
    read exactly once even when equal keys straddle two chunks.  No chunks ->
    one predicate reading everything.
    """
    def lit(v):
        if isinstance(v, bool) or not isinstance(v, (str, int, float, Decimal, date)):
            raise TypeError(f"no SQL literal for a bound of type {type(v).__name__}")
        return str(v) if isinstance(v, (int, float, Decimal)) else "'" + str(v).replace("'", "''") + "'"

    # The database's own order: its collation may differ from ours.
    los = [lo for lo, _ in itertools.groupby(lo for lo, _hi in bounds if lo is not None)]
    preds = []
    for i, lo in enumerate(los):
        parts = []
        if i > 0:
            parts.append(f"{key} >= {lit(lo)}")
        if i + 1 < len(los):
            parts.append(f"{key} < {lit(los[i + 1])}")
        pred = " AND ".join(parts) if parts else "1=1"
        if i == 0:
            pred = f"({pred}) OR {key} IS NULL" if parts else pred
        preds.append(pred)
    if not preds:
        preds = ["1=1"]
    if where:
        preds = [f"({p}) AND ({where})" for p in preds]
    return preds


def extent_span(df: DataFrame, file: str, block: str, blocks: str) -> DataFrame:
    """Per file the first block, the end of the last extent (its start
    + its length - 1) and the total length, as one aggregate."""
    return (df.groupBy(F.col(file))
            .agg(F.min(block).alias("first_block"),
                 (F.max(block) + F.max_by(blocks, block) - F.lit(1)).alias("last_block"),
                 F.sum(blocks).alias("total_blocks")))


def partition_ranges(df: DataFrame, partition_col: str, key: str) -> DataFrame:
    """R13 (per-partition mode): one key range per partition value of the
    table, ``(partition, lo, hi, rows)``, from one aggregate."""
    return (df.groupBy(F.col(partition_col).alias("partition"))
            .agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
                 F.count(F.lit(1)).alias("rows")))
