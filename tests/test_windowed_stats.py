"""Statistics per interval: late rows apart, no interval twice after a restart."""

import datetime as dt

from pyspark.sql import functions as F

from loadbay.streaming import stats

SCHEMA = "ts timestamp_ntz, v string, bad boolean"


def _rows(*minutes, v="abc", bad=False):
    return [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), v, bad) for m in minutes]


def test_windows_restart_and_late_rows(spark, tmp_dir):
    def run(batch, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_dir}/in")
        per = stats.windowed_stats(stream, "ts", "10 minutes", "5 minutes", is_dirty=F.col("bad"), columns=["v"])
        query = stats.append_stats(per, f"{tmp_dir}/out", f"{tmp_dir}/checkpoint")
        query.awaitTermination()
        got = spark.read.schema(per.schema).parquet(f"{tmp_dir}/out").orderBy("start").collect()
        return {(r["start"].minute): (r["read_rows"], r["discard_rows"], r["write_rows"], r["chars"]) for r in got}, \
            len(got), stats.late_rows(query)

    # Watermark at 0:23: the windows from 0:00 and 0:10 are closed.
    got, n, late = run(1, _rows(1, 2, 12, 28) + _rows(3, bad=True) + _rows(13, v=None) + [(None, "x", False)])
    assert got == {0: (3, 1, 2, 9), 10: (2, 0, 2, 3)} and n == 2 and late == 0
    # A restart: 0:05 is late, 0:24 is not; 0:47 closes 0:20 and 0:30.
    got, n, late = run(2, _rows(5, 24, 31, 47))
    assert got == {0: (3, 1, 2, 9), 10: (2, 0, 2, 3), 20: (2, 0, 2, 6), 30: (1, 0, 1, 3)} and n == 4 and late == 1


def test_speeds(spark, tmp_dir):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i % 10), "x" * 50_000, False) for i in range(60)]
    spark.createDataFrame(rows + _rows(30), SCHEMA).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_dir}/in")
    query = stats.append_stats(stats.windowed_stats(stream, "ts", "10 seconds"), f"{tmp_dir}/out", f"{tmp_dir}/c")
    query.awaitTermination()
    first = spark.read.parquet(f"{tmp_dir}/out").orderBy("start").first()
    assert (first["read_rows"], first["byte_speed"], first["line_speed"]) == (60, "300KB/s", "6L/s")
