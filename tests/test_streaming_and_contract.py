"""Streaming sources/fan-out and the driver contract."""

import os

from pyspark.sql import functions as F

from loadbay.streaming import lines as st

from conftest import SF_CHECK


def test_line_stream_fan_out(spark, tmp_dir):
    inbox = f"{tmp_dir}/inbox"
    os.makedirs(inbox)
    with open(f"{inbox}/a.txt", "w") as fh:
        fh.write("1\tx\t\\N\n2\t\t\n")
    stream = st.read_line_stream(spark, inbox, field_split="\t", null_string="\\N", num_fields=3,
                                 legacy_last_field=True)
    q = st.fan_out_stream(stream, {"a": st.parquet_sink(f"{tmp_dir}/a"),
                                   "b": st.parquet_sink(f"{tmp_dir}/b"),
                                   "console": st.print_sink("|", "> ", "NULL")},
                          checkpoint=f"{tmp_dir}/ckpt", stats_path=f"{tmp_dir}/stats")
    q.awaitTermination()
    stats = spark.read.parquet(f"{tmp_dir}/stats").agg(F.sum("read_rows"), F.sum("chars")).first()
    assert tuple(stats) == (2, 5)   # "1"+"x"+"\\N" and "2"
    for sink in ("a", "b"):
        rows = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/{sink}").drop("_epoch").collect())
        assert rows == [("1", "x", "\\N"), ("2", "", "")]
    # a restart with no new files adds nothing (the checkpoint remembers)
    with open(f"{inbox}/b.txt", "w") as fh:
        fh.write("3\ty\tz\n")
    q = st.fan_out_stream(st.read_line_stream(spark, inbox, num_fields=3),
                          {"a": st.parquet_sink(f"{tmp_dir}/a")}, checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 3


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "sum_qty" in df.columns


def test_contract_keys_match():
    import __spark_entry__ as e

    qs, sql = e.queries(), e.oracle_sql()
    from loadbay.plans import PLANS

    assert set(PLANS) <= set(sql) <= set(qs)   # every exchange query has its DuckDB SQL


def test_some_queries_against_duckdb(spark):
    """A few registered queries compared with their DuckDB SQL at sf0.01."""
    import duckdb

    import __spark_entry__ as e
    from oracle_check import compare
    from loadbay.plans.common import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    qs, sql = e.queries(), e.oracle_sql()
    for key in ("key_range_chunks", "load_replace", "cells_to_rows", "parse_dates", "split_regex_trailing"):
        line = compare(spark, con, key, qs[key], sql[key], SF_CHECK)
        assert ": OK" in line, line


def test_constant_stream(spark):
    import time

    from loadbay.sources.generate import constant_stream

    stream = constant_stream(spark, "x", rows_per_second=50, field_num=2, num_partitions=2)
    q = (stream.writeStream.format("memory").queryName("loadbay_const")
         .trigger(processingTime="200 milliseconds").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("loadbay_const").count() < 5:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.table("loadbay_const").collect()
    assert len(rows) >= 5 and all(tuple(r) == ("x", "x") for r in rows)


def test_stream_into_key_policy_table(spark, tmp_dir):
    inbox = f"{tmp_dir}/inbox"
    os.makedirs(inbox)
    with open(f"{inbox}/a.txt", "w") as fh:
        fh.write("1\ta\t1\n2\tb\t2\n1\tc\t3\n")
    rows = st.read_line_stream(spark, inbox, num_fields=3, max_files_per_trigger=1).select(
        F.col("_c0").cast("bigint").alias("id"), F.col("_c1").alias("v"),
        F.col("_c2").cast("bigint").alias("seq"))
    table = f"{tmp_dir}/table"
    q = st.fan_out_stream(rows, {"t": st.key_policy_sink(table, "id", "replace", "seq")},
                          checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination()
    with open(f"{inbox}/b.txt", "w") as fh:
        fh.write("2\td\t4\n3\te\t5\n")
    q = st.fan_out_stream(rows, {"t": st.key_policy_sink(table, "id", "replace", "seq")},
                          checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(table).collect())
    assert got == [(1, "c", 3), (2, "d", 4), (3, "e", 5)]


def test_stream_sets_dirty_rows_aside(spark, tmp_dir):
    from loadbay.operators import quality as q

    inbox = f"{tmp_dir}/inbox"
    os.makedirs(inbox)
    with open(f"{inbox}/a.txt", "w") as fh:
        fh.write("1\tx\nbad\ty\n3\tz\n")
    stream = st.read_line_stream(spark, inbox, num_fields=2)
    query = st.fan_out_stream(stream, {"a": st.parquet_sink(f"{tmp_dir}/a")},
                              checkpoint=f"{tmp_dir}/ckpt", stats_path=f"{tmp_dir}/stats",
                              rules=q.type_rules({"_c0": "int"}), dirty_path=f"{tmp_dir}/dirty")
    query.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_dir}/a").select("_c0").collect()) == ["1", "3"]
    dirty = spark.read.parquet(f"{tmp_dir}/dirty").collect()
    assert [(r["_c0"], r[q.DIRTY_REASON]) for r in dirty] == [("bad", "bad__c0")]
    stats = spark.read.parquet(f"{tmp_dir}/stats").agg(F.sum("read_rows"), F.sum("discard_rows"),
                                                      F.sum("write_rows")).first()
    assert tuple(stats) == (3, 1, 2)


def test_gbk_line_stream(spark, tmp_dir):
    inbox = f"{tmp_dir}/inbox"
    os.makedirs(inbox)
    with open(f"{inbox}/a.txt", "wb") as fh:
        fh.write("中文\t测试\n".encode("gbk"))
    stream = st.read_line_stream(spark, inbox, num_fields=2, encoding="GBK")
    q = st.fan_out_stream(stream, {"a": st.parquet_sink(f"{tmp_dir}/a")}, checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/a").drop("_epoch").collect()] == [("中文", "测试")]
