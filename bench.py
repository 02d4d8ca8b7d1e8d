"""Bench: every query of the reference's operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs end to end (its writes and reads included) and its result is
driven into the ``noop`` sink, so nothing is collected to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

def warm_up(spark, sf_dir: str) -> None:
    """Load the JVM's classes and code generators outside the timings: a
    tiny text round trip with an aggregate, a persisted frame and a Python
    worker, all on the 25-row nation table."""
    from pyspark import StorageLevel
    from pyspark.sql import functions as F

    from loadbay.session import scratch_path
    from loadbay.sinks.files import write_delimited
    from loadbay.sources.files import read_delimited

    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    path = write_delimited(nation, scratch_path(spark, "warmup"))
    rows = read_delimited(spark, path, field_split="\x01", num_fields=3)
    rows.groupBy("_c2").agg(F.count(F.lit(1))).collect()
    kept = nation.persist(StorageLevel.DISK_ONLY)
    kept.count()
    kept.unpersist()
    nation.mapInPandas(lambda it: it, nation.schema).count()


def main() -> None:
    from loadbay.plans import PLANS
    from loadbay.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")),
                          app="loadbay-bench")
    warm_up(spark, sf_dir)

    keys = sys.argv[1:] or list(PLANS)
    times: dict[str, float] = {}
    for key in keys:
        t0 = time.perf_counter()
        PLANS[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
