"""Session helpers: the shared scratch folder and a local session for tests.

Intermediate tables (round trips, fan-out sinks, lineage cuts) go below the
folder the cluster names in ``spark.checkpoint.dir``.  Only when the session
has none (local tests, the bench) do we create one in ``/tmp``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is not shared by a cluster's executors.
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        # Unset in a local run (tests, the bench): a fresh local folder.
        configured = tempfile.mkdtemp(prefix="loadbay-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/loadbay-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared scratch folder and read it back: its
    lineage ends there, and a lost executor reads files again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "loadbay") -> SparkSession:
    """Session used by tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LOADBAY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.legacy.javaCharsets", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
