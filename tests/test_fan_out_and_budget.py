"""Sinks side by side, and loads that stop as soon as their budget is broken."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from loadbay.operators import quality as q


def test_sinks_run_side_by_side(spark, tmp_dir):
    both = threading.Barrier(2, timeout=60)  # each sink waits for the other

    def sink(name):
        def write(df):
            both.wait()
            df.write.parquet(f"{tmp_dir}/{name}")
        return write

    df = spark.range(1000).withColumn("v", F.rand())  # a source that differs when it is read again
    counts = q.fan_out(df, {"a": sink("a"), "b": sink("b")})
    assert counts == {"a": 1000, "b": 1000}
    a, b = (spark.read.parquet(f"{tmp_dir}/{x}") for x in "ab")
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("parallel", [True, False])
def test_a_failing_sink_stops_alone(spark, tmp_dir, parallel):
    def broken(df):
        df.select(F.raise_error(F.lit("no room"))).write.format("noop").mode("overwrite").save()

    def slow(df):
        time.sleep(1)
        df.write.parquet(f"{tmp_dir}/slow")

    df = spark.range(500)
    assert q.fan_out(df, {"bad": broken, "good": slow}, on_sink_error="drop", parallel=parallel) == {
        "bad": None, "good": 500}
    assert spark.read.parquet(f"{tmp_dir}/slow").count() == 500
    with pytest.raises(Exception, match="no room"):
        q.fan_out(df, {"bad": broken, "other": lambda d: d.write.parquet(f"{tmp_dir}/x")}, parallel=parallel)


def test_default_is_the_shared_checkpoint(spark, tmp_dir):
    seen = []
    q.fan_out(spark.range(10), {"a": lambda df: (seen.append(df), df.write.format("noop").mode("overwrite").save())})
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    assert "Scan ExistingRDD" in seen[0]._jdf.queryExecution().executedPlan().toString()


def _slow_rows(spark, folder, parts, dirty_parts):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        time.sleep(0.1 if part < dirty_parts else 1.0)
        open(f"{folder}/{part}", "w").close()
        yield from batches

    rows = spark.range(0, parts * 10, 1, parts)
    return rows.mapInArrow(run, rows.schema).withColumn("bad", F.col("id") < dirty_parts * 10)


@pytest.mark.parametrize("limit,expected", [(5.0, None), (0.01, 4800)])
def test_a_broken_budget_ends_the_load(spark, tmp_dir, limit, expected):
    started = f"{tmp_dir}/started"
    os.mkdir(started)
    target = f"{tmp_dir}/target"
    spark.range(3).write.parquet(target)
    parts = 48
    rows = _slow_rows(spark, started, parts, dirty_parts=8)
    with pytest.raises(q.LoadRejected, match="stopped"):
        q.load_checked(rows, {"bad": F.col("bad")}, limit, target, stop_early=True, expected_rows=expected)
    assert len(os.listdir(started)) < parts
    assert spark.read.parquet(target).count() == 3
    assert [x for x in os.listdir(tmp_dir) if "_staging_" in x] == []


def test_a_load_within_its_budget_is_not_stopped(spark, tmp_dir):
    rows = spark.range(0, 100, 1, 5).withColumn("bad", F.col("id") < 5)
    got = q.load_checked(rows, {"bad": F.col("bad")}, 5.0, f"{tmp_dir}/t", stop_early=True, dirty_path=f"{tmp_dir}/d")
    assert (got["rows"], got["rejected"]) == (100, 5)
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 95 and spark.read.parquet(f"{tmp_dir}/d").count() == 5
    with pytest.raises(q.LoadRejected):
        q.load_checked(rows, {"bad": F.col("bad")}, 4.0, f"{tmp_dir}/t", stop_early=True)
