"""Bounds by histogram and reads planned from file metadata."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loadbay.operators import extents as ex
from loadbay.operators.bounds import key_range_select
from loadbay.operators.ranges import key_range_chunks


def _same(df, key, n, bits=8):
    got = sorted(tuple(r) for r in key_range_select(df, key, n, bits).collect())
    want = sorted(tuple(r) for r in key_range_chunks(df, key, n).select("chunk", "lo", "hi", "rows").collect())
    assert got == want


@pytest.mark.parametrize("n", [1, 7, 50])
@pytest.mark.parametrize("bits", [1, 8])
def test_bounds_equal_the_sorted_ones(spark, n, bits):
    rnd = random.Random(n)
    rows = [(None if i < 12 else 42 if i % 3 == 0 else rnd.randrange(-10_000, 10_000),) for i in range(400)]
    _same(spark.createDataFrame(rows, "k long").repartition(5), "k", n, bits)


def test_bounds_of_other_types(spark):
    days = [(dt.date(1960, 1, 1) + dt.timedelta(days=37 * i % 5000),) for i in range(100)]
    _same(spark.createDataFrame(days, "k date"), "k", 9)
    prices = [(Decimal(i * 7919 % 1000) / 100 - 5,) for i in range(100)]
    _same(spark.createDataFrame(prices, "k decimal(9,2)"), "k", 9)
    times = spark.range(90).select(F.timestamp_seconds(F.col("id") * 7919 % 100000 - 50000).alias("k"))
    _same(times, "k", 9)
    _same(spark.createDataFrame([(True,), (False,), (None,), (True,)], "k boolean"), "k", 3)


def test_bounds_edge_cases(spark):
    assert key_range_select(spark.createDataFrame([], "k long"), "k", 5).collect() == []
    _same(spark.createDataFrame([(None,), (None,)], "k int"), "k", 5)
    _same(spark.createDataFrame([(3,)] * 10, "k int"), "k", 4)
    _same(spark.createDataFrame([(2 ** 62,), (-5,), (0,)], "k long"), "k", 2)
    with pytest.raises(TypeError):
        key_range_select(spark.createDataFrame([("a",)], "k string"), "k", 5)
    with pytest.raises(OverflowError):
        key_range_select(spark.createDataFrame([(2 ** 63 - 1,), (-(2 ** 63),)], "k long"), "k", 2)


def test_bounds_do_not_sort_or_shuffle_rows(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 65_521).alias("k"))
    plan = key_range_select(df, "k", 20)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_extents_are_balanced_and_read_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    (rows.repartition(3).write.option("parquet.block.size", 32 * 1024)
     .option("parquet.page.size.row.check.min", 100).parquet(path))
    extents = ex.file_extents(spark, path)
    assert extents.agg(F.sum("rows")).first()[0] == 20_000 and extents.count() > 12
    n = 5
    chunks = ex.extent_chunks(extents, n)
    sizes = {r["chunk"]: r["size"] for r in chunks.groupBy("chunk").agg(F.sum("bytes").alias("size")).collect()}
    largest = extents.agg(F.max("bytes")).first()[0]
    share = sum(sizes.values()) / n
    assert set(sizes) == set(range(n)) and all(abs(s - share) <= largest for s in sizes.values())
    order = [r["chunk"] for r in chunks.orderBy("path", "extent").collect()]
    assert order == sorted(order)
    back = ex.read_extents(spark, chunks, path, n)
    assert Counter(r["id"] for r in back.collect()) == Counter(range(20_000))
    assert ex.read_extents(spark, chunks, path, n, columns=["v"]).columns == ["v", "chunk"]


def test_a_file_is_opened_once_per_chunk(tmp_path, monkeypatch):
    files = [f"file://{tmp_path}/{name}.parquet" for name in "ab"]
    for k, file in enumerate(files):
        pq.write_table(pa.table({"id": range(100 * k, 100 * k + 100)}), file[7:], row_group_size=10)
    opened, real = [], ex._open
    monkeypatch.setattr(ex, "_open", lambda where: opened.append(where) or real(where))
    rows = [(files[k], i, (10 * k + i) // 7) for k in range(2) for i in range(10)]
    listed = pa.table(list(zip(*rows)), names=["path", "extent", "chunk"]).to_batches(max_chunksize=3)
    got = pa.Table.from_batches(ex._extent_rows(["id"])(iter(listed)))
    assert got.column("id").to_pylist() == list(range(200))
    assert got.column("chunk").to_pylist() == [i // 70 for i in range(200)]
    assert opened == [files[0]] * 2 + [files[1]] * 2


def test_no_extents(spark, tmp_dir):
    path = f"{tmp_dir}/none"
    spark.range(0).write.parquet(path)
    chunks = ex.extent_chunks(ex.file_extents(spark, path), 4)
    assert ex.read_extents(spark, chunks, path, 4).collect() == []
