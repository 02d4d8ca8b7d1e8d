"""Replacing a folder by a freshly written one."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def swap_in(spark: SparkSession, fresh: str, target: str) -> None:
    """Move ``fresh`` to ``target``.

    An existing target is moved aside first, put back if the move fails, and
    deleted only after it succeeded; ``fresh`` is never deleted."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    path = jvm.org.apache.hadoop.fs.Path
    live, new = path(target), path(fresh)
    old = path(f"{target.rstrip('/')}._old_{uuid.uuid4().hex[:12]}")
    fs = live.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    had = fs.exists(live)
    if had and not fs.rename(live, old):
        raise RuntimeError(f"could not move {target} aside")
    if not _moved(fs, new, live):
        if had:
            fs.rename(old, live)
        raise RuntimeError(f"could not move {fresh} to {target}")
    if had:
        fs.delete(old, True)


def _moved(fs, new, live) -> bool:
    return bool(fs.rename(new, live))
