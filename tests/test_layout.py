"""Where files land and what is listed: partition folders and routed targets."""

import glob
import os

from pyspark.sql import functions as F

from loadbay.sinks import catalog
from loadbay.sources import files as src


def test_only_wanted_folders_are_listed(spark, tmp_dir):
    root = f"{tmp_dir}/p"
    rows = spark.range(40).select(
        F.col("id").cast("string").alias("value"), F.concat(F.lit("2016:"), F.col("id") % 2).alias("pt"),
        (F.col("id") % 5).cast("string").alias("hour"))
    catalog.write_partitioned(rows, root, ["pt", "hour"])
    os.mkdir(f"{root}/pt=odd")  # a folder of another depth that must not be looked at
    open(f"{root}/pt=odd/x", "w").close()
    for values, n in ((["2016:1", None], 20), (["2016:1", "3"], 4), (["2016:0", "9"], 0)):
        got = src.read_partition(spark, root, ["pt", "hour"], values, num_fields=1)
        assert got.columns == ["_c0", "pt", "hour"] and got.count() == n
        assert all("pt=odd" not in f for f in got.inputFiles())
        if n:
            assert {r["pt"] for r in got.collect()} == {values[0]}
    os.remove(f"{root}/pt=odd/x")
    os.rmdir(f"{root}/pt=odd")
    late = src.read_partition(spark, root, ["pt", "hour"], [None, "3"], num_fields=1)
    assert late.count() == 8 and len(late.inputFiles()) == 2


def test_targets_get_files_by_their_size(spark, tmp_dir):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 60_000, 1, 12).select(
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.concat(F.lit("s_"), F.when(F.col("id") % 100 < 95, F.lit("hot")).otherwise(
                F.concat(F.lit("t"), F.col("id") % 5)), F.lit("_0")).alias("src"))
        root = catalog.route_shards(rows, "src", f"{tmp_dir}/r")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {os.path.basename(d): len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{root}/target=*")}
    hot = max(files, key=files.get)
    # A small target is one file unless it is dealt with the hot one.
    small = [n for t, n in files.items() if t != hot]
    assert files[hot] > 4 and sum(n == 1 for n in small) >= len(small) - 2
    assert spark.read.parquet(root).count() == 60_000
