"""Shared helpers of the registered plans: table loading and scratch space."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadbay.session import scratch_path

# The driver's test tables.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
