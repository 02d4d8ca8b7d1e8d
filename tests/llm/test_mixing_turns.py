"""The offset of a mixed source: drawn once, turned, the place nearest the target used."""

import hashlib
import math
from collections import defaultdict

import duckdb

from loadbay.llm import mixing
from loadbay.llm.queries import ORACLE_SQL, op3_systematic_mix

#: source -> sizes of its documents; sizes far apart, so places differ in words.
SIZES = {"a": [3, 4, 9, 30, 41, 2, 17], "b": [1, 1, 2, 60, 75, 8, 90, 33, 5], "c": [0, 12, 40, 7, 7, 100, 3, 21],
         None: [5, 80, 6, 6, 44, 1]}


def _docs(spark):
    rows = [(100 * k + i, s, " ".join(["w"] * n) if n else None)
            for k, (s, sizes) in enumerate(SIZES.items()) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def _taken(rows, target, source_size, u):
    rate = target / source_size
    copies = {i: min(math.floor(u + rate * (k + 1)) - math.floor(u + rate * k), math.ceil(rate))
              for k, (n, i) in enumerate(sorted(rows))}
    return copies, sum(copies[i] * n for n, i in rows)


def test_the_place_nearest_the_target_is_used(spark):
    got = mixing.plan_copies(_docs(spark)).collect()
    assert len(got) == sum(map(len, SIZES.values()))
    by_source = defaultdict(list)
    for r in got:
        by_source[r.doc_id // 100].append(r)
    nearer = 0
    for k, source in enumerate(SIZES):
        rows = by_source[k]
        target, source_size = rows[0].target, rows[0].source_size
        sized = [(r["size"], r.doc_id) for r in rows]
        u = int(hashlib.md5(f"1:{source or ''}".encode()).hexdigest()[:6], 16) / (1 << 24)
        places = [_taken(sized, target, source_size, (u + t / 16) % 1.0) for t in range(16)]
        copies, taken = min(places, key=lambda p: abs(p[1] - target))
        assert {r.doc_id: r.copies for r in rows} == copies
        assert sum(r.taken for r in rows) == taken and all(r.taken <= 3 * r["size"] for r in rows)
        nearer += abs(taken - target) < abs(places[0][1] - target)
    assert nearer >= 2  # the drawn place alone would not do


def test_every_copy_of_the_plan_is_in_the_mix(spark):
    docs = _docs(spark)
    plan = {r.doc_id: r.copies for r in mixing.plan_copies(docs).where("copies > 0").collect()}
    assert {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()} == plan


def test_sql_tries_every_place(spark, tmp_dir):
    _docs(spark).coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    sql = ORACLE_SQL["op3_systematic_mix"]
    assert f"m{mixing.TURNS - 1}" in sql
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, copies, taken FROM ({sql})").fetchall())
    got = op3_systematic_mix(spark, tmp_dir).select("doc_id", "size", "source_size", "copies", "taken")
    assert sorted(map(tuple, got.collect())) == want
