"""Constant rows for load tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the generator's default field count.
DEFAULT_FIELD_NUM = 0


def constant_rows(spark: SparkSession, n: int, field: str,
                  field_num: int = DEFAULT_FIELD_NUM, num_partitions: int | None = None) -> DataFrame:
    """``n`` rows of ``field_num`` copies of ``field`` (``_c0..``),
    generated by the executors (``range``), ``num_partitions`` generators."""
    base = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    if field_num <= 0:
        return base.select()
    return base.select([F.lit(field).alias(f"_c{i}") for i in range(field_num)])


def constant_stream(spark: SparkSession, field: str, rows_per_second: int = 1000,
                    field_num: int = DEFAULT_FIELD_NUM, num_partitions: int | None = None) -> DataFrame:
    """R18 unbounded: the ``rate`` source with constant fields."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if num_partitions:
        r = r.option("numPartitions", num_partitions)
    base = r.load()
    return base.select([F.lit(field).alias(f"_c{i}") for i in range(max(field_num, 0))] or
                       [F.col("value").alias("_seq")])
