"""Operators checked against brute force on small fixtures, including a
hot key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from loadbay.operators import cells as cl
from loadbay.operators import policy as pol
from loadbay.operators import quality as q
from loadbay.operators import ranges as rg


def brute_ntile(keys, n):
    keys = sorted(keys)
    total = len(keys)
    qn, rem = divmod(total, n)
    out, pos = [], 0
    for g in range(n):
        size = qn + (1 if g < rem else 0)
        if size == 0:
            continue
        part = keys[pos:pos + size]
        out.append((g, part[0], part[-1], size))
        pos += size
    return out


@pytest.mark.parametrize("rows,n,parts", [(1000, 7, 4), (10, 200, 3), (199, 200, 8), (5000, 200, 16)])
def test_key_range_chunks_exact(spark, rows, n, parts):
    keys = random.Random(rows).sample(range(rows * 10), rows)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = sorted(tuple(r) for r in rg.key_range_chunks(df, "k", n, num_partitions=parts).collect())
    assert got == brute_ntile(keys, n)


def test_key_range_chunks_empty(spark):
    df = spark.createDataFrame([], "k bigint")
    assert rg.key_range_chunks(df, "k", 10).count() == 0


def test_chunk_predicates():
    assert rg.chunk_predicates([(1, 5), (6, 9), (6, 12)], "id", "x > 0") == [
        "((id < 6) OR id IS NULL) AND (x > 0)", "(id >= 6) AND (x > 0)"]
    assert rg.chunk_predicates([(1, 5), (6, 9), (10, 12)], "id") == [
        "(id < 6) OR id IS NULL", "id >= 6 AND id < 10", "id >= 10"]
    assert rg.chunk_predicates([("a'b", "c")], "k") == ["1=1"]
    assert rg.chunk_predicates([], "id") == ["1=1"]


def test_key_range_chunks_hot_key_is_spread(spark):
    keys = [7] * 3000 + list(range(100, 6100))      # one key holds a third
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = sorted(tuple(r) for r in rg.key_range_chunks(df, "k", 50, num_partitions=8).collect())
    assert got == brute_ntile(keys, 50)
    ranked = rg.global_rank(df, "k", 8)
    per_part = (ranked.filter("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(per_part) > 1   # the hot key is not in one task


def test_extent_span(spark):
    df = spark.createDataFrame([("f1", 10, 8), ("f1", 30, 4), ("f1", 20, 2), ("f2", 5, 1)],
                               "file string, block int, blocks int")
    got = {r[0]: tuple(r[1:]) for r in rg.extent_span(df, "file", "block", "blocks").collect()}
    assert got == {"f1": (10, 33, 14), "f2": (5, 5, 1)}


# ------------------------------------------------------------ load policy

def _policy_fixture(spark):
    target = [(1, "t1", 0), (2, "t2", 0), (None, "tnull", 0)]
    rnd = random.Random(3)
    incoming = []
    seq = 0
    for _ in range(300):  # hot key 2 holds a third of the batch
        seq += 1
        incoming.append((2, f"hot{seq}", seq))
    for _ in range(600):
        seq += 1
        incoming.append((rnd.choice([1, 3, 4, 5, None]), f"v{seq}", seq))
    schema = "id bigint, v string, seq bigint"
    return (spark.createDataFrame(target, schema), spark.createDataFrame(incoming, schema),
            target, incoming)


def brute_policy(target, incoming, policy):
    tkeys = {t[0] for t in target if t[0] is not None}
    nulls = [r for r in incoming if r[0] is None]
    by_key = {}
    for r in sorted((r for r in incoming if r[0] is not None), key=lambda r: r[2]):
        if policy == "ignore":
            by_key.setdefault(r[0], r)
        else:
            by_key[r[0]] = r
    if policy == "ignore":
        return sorted(target + [r for k, r in by_key.items() if k not in tkeys] + nulls,
                      key=str)
    kept = [t for t in target if t[0] is None or t[0] not in by_key]
    return sorted(kept + list(by_key.values()) + nulls, key=str)


@pytest.mark.parametrize("policy", ["ignore", "replace"])
def test_load_policy_brute_force(spark, policy):
    t_df, i_df, target, incoming = _policy_fixture(spark)
    got = sorted((tuple(r) for r in pol.load_with_key_policy(t_df, i_df, "id", policy, "seq").collect()),
                 key=str)
    assert got == brute_policy(target, incoming, policy)


def test_load_policy_rejects_unknown(spark):
    t_df, i_df, *_ = _policy_fixture(spark)
    with pytest.raises(ValueError):
        pol.load_with_key_policy(t_df, i_df, "id", "merge", "seq")


def test_pick_per_key_is_an_aggregate(spark):
    _, i_df, *_ = _policy_fixture(spark)
    plan = pol.pick_per_key(i_df, "id", "seq", last=True)._jdf.queryExecution().executedPlan().toString()
    # partial aggregation before the shuffle keeps a hot key cheap; no window
    assert "Window" not in plan and "Aggregate" in plan


# ------------------------------------------------------------ cells

def test_rows_cells_round_trip(spark):
    rows = spark.createDataFrame([("k1", "a", None), ("k2", None, "y"), (None, "z", "z"), ("k3", None, None)],
                                 "key string, a string, b string")
    cells, dirty = cl.rows_to_cells(rows, 0, ["cf:a", "cf:b"], ts=1)
    assert dirty.count() == 1
    got = sorted(tuple(r) for r in cells.select("rowkey", "family", "qualifier", "value").collect())
    assert got == [("k1", "cf", "a", "a"), ("k2", "cf", "b", "y")]
    back = cl.cells_to_rows(cells, ["cf:a", "cf:b"], keep_key=True)
    assert sorted(tuple(r) for r in back.collect()) == [("k1", "a", None), ("k2", None, "y")]


def test_cells_to_rows_newest_version_and_range(spark):
    cells = spark.createDataFrame(
        [("r1", "f", "q", 1, "old"), ("r1", "f", "q", 5, "new"), ("r1", "f", "x", 9, "other"),
         ("r2", "f", "q", 3, "r2v"), ("r3", "f", "x", 1, "only-x")] +
        [("hot", "f", "q", i, f"v{i}") for i in range(200)],
        cl.CELL_SCHEMA)
    out = cl.cells_to_rows(cells, ["f:q"], keep_key=True)
    got = {r[0]: r[1] for r in out.collect()}
    assert got == {"r1": "new", "r2": "r2v", "hot": "v199"}   # r3 has no chosen cell
    ranged = cl.cells_to_rows(cells, ["f:q"], start="r1", stop="r2", keep_key=True)
    assert [tuple(r) for r in ranged.collect()] == [("r1", "new")]


def test_clip_ranges(spark):
    regions = spark.createDataFrame([(None, "b"), ("b", "d"), ("d", None)], "start string, stop string")
    got = [tuple(r) for r in cl.clip_ranges(regions, "c", "e").select("clip_start", "clip_stop").collect()]
    assert sorted(got, key=str) == sorted([("c", "d"), ("d", "e")], key=str)
    with pytest.raises(ValueError):
        cl.clip_ranges(regions, "z", "a")


def test_column_name_must_have_family():
    with pytest.raises(ValueError):
        cl.split_column_name("nofamily")


# ------------------------------------------------------------ quality

@pytest.mark.parametrize("rows,rejected,limit,inclusive,ok", [
    (0, 0, 5, False, True), (10, 3, 0, False, True), (10, 3, 0.3, False, True),
    (10, 4, 0.3, False, False), (10, 3, 3, False, True), (10, 4, 3, False, False),
    (10, 3, 3, True, False), (10, 2, 3, True, True), (10, 3, 0.3, True, False),
    (10, 2, 0.3, True, True), (10, 9, 0, True, True), (0, 0, 0.5, True, True),
])
def test_limit_ok(spark, rows, rejected, limit, inclusive, ok):
    df = spark.range(1)
    got = df.select(q.limit_ok(F.lit(rows), F.lit(rejected), F.lit(float(limit)), inclusive)).first()[0]
    assert got == ok


def test_check_limit_and_dirty(spark):
    df = spark.createDataFrame([("1",), ("x",), ("3",), ("",)], "n string")
    rules = q.type_rules({"n": "int"})
    good, dirty = q.split_dirty(df, rules)
    assert good.count() == 3 and dirty.count() == 1
    assert dirty.first()[q.DIRTY_REASON] == "bad_n"
    r = q.check_limit(df, F.col("n") == "x", 0.2).first()
    assert (r["rows"], r["rejected"], r["ok"]) == (4, 1, False)


@pytest.mark.parametrize("amount,secs,text", [
    (0, 0, "0B/s"), (5, 10, "1B/s"), (999, 1, "999B/s"), (2500, 1, "2KB/s"),
    (3_500_000, 1, "3MB/s"), (10_000, 0, "10KB/s")])
def test_speed_text(spark, amount, secs, text):
    got = spark.range(1).select(q.speed_text(F.lit(amount), F.lit(secs))).first()[0]
    assert got == text


def test_transfer_stats(spark):
    df = spark.createDataFrame([("ab", 1), (None, 22), ("xyz", None)], "a string, b int")
    r = q.transfer_stats(df, is_dirty=F.col("b").isNull(), seconds=2).first()
    assert (r["read_rows"], r["discard_rows"], r["write_rows"], r["chars"], r["avg_len"]) == (3, 1, 2, 8, 2)
    assert (r["read_bytes"], r["write_bytes"], r["discard_bytes"]) == (6, 3, 2)
    assert r["line_speed"] == "1L/s" and r["byte_speed"] == "4B/s"


def test_fan_out_and_reconcile(spark, tmp_dir):
    df = spark.range(100).select(F.col("id").cast("string").alias("v"))
    counts = q.fan_out(df, {
        "a": lambda d: d.write.mode("overwrite").parquet(f"{tmp_dir}/a"),
        "b": lambda d: d.filter("v != '1'").write.mode("overwrite").parquet(f"{tmp_dir}/b"),
    })
    assert counts == {"a": 100, "b": 100}  # each sink was offered every row
    held = q.count_sink_rows({"a": spark.read.parquet(f"{tmp_dir}/a"),
                              "b": spark.read.parquet(f"{tmp_dir}/b")})
    rec = {r["sink"]: (r["rows"], r["ok"]) for r in q.reconcile(held).collect()}
    assert rec == {"a": (100, False), "b": (99, False)}
    assert q.status_code(q.reconcile(held)).first()[0] == 200


def test_fan_out_drop_failing_sink(spark):
    df = spark.range(10)

    def boom(_):
        raise RuntimeError("sink down")

    counts = q.fan_out(df, {"bad": boom, "good": lambda d: d.write.format("noop").mode("overwrite").save()},
                       on_sink_error="drop")
    assert counts == {"bad": None, "good": 10}
    with pytest.raises(RuntimeError):
        q.fan_out(df, {"bad": boom})


def test_load_checked_commits_or_rejects(spark, tmp_dir):
    import os

    df = spark.createDataFrame([(str(i) if i % 4 else "x",) for i in range(40)], "n string")
    rules = q.type_rules({"n": "int"})
    with pytest.raises(q.LoadRejected):
        q.load_checked(df, rules, 0.1, f"{tmp_dir}/rejected")
    assert not os.path.exists(f"{tmp_dir}/rejected")
    assert not [p for p in os.listdir(tmp_dir) if "_staging_" in p]
    out = q.load_checked(df, rules, 10, f"{tmp_dir}/ok", dirty_path=f"{tmp_dir}/dirty")
    assert (out["rows"], out["rejected"]) == (40, 10)
    assert spark.read.parquet(f"{tmp_dir}/ok").count() == 30
    assert spark.read.parquet(f"{tmp_dir}/dirty").count() == 10


def test_fan_out_from_checkpoint(spark, tmp_dir):
    df = spark.range(50).select((F.col("id") * 2).alias("v"))
    counts = q.fan_out(df, {
        "a": lambda d: d.write.mode("overwrite").parquet(f"{tmp_dir}/a"),
        "b": lambda d: d.write.format("noop").mode("overwrite").save(),
    }, materialize="checkpoint")
    assert counts == {"a": 50, "b": 50}
    assert spark.read.parquet(f"{tmp_dir}/a").agg(F.sum("v")).first()[0] == 2450


def test_exchange_report(spark, tmp_dir):
    df = spark.createDataFrame([(str(i) if i % 5 else "bad",) for i in range(20)], "n string")
    rep = q.exchange(df, {
        "a": lambda d: d.write.mode("overwrite").parquet(f"{tmp_dir}/a"),
        "b": lambda d: d.write.format("noop").mode("overwrite").save(),
    }, rules=q.type_rules({"n": "int"}), limit=0.1, seconds=1)
    got = {r["sink"]: r for r in rep.collect()}
    assert got["a"]["rows"] == 16 and got["a"]["ok"] and got["a"]["discard_rows"] == 4
    assert got["a"]["chars"] == sum(len(str(i)) for i in range(20) if i % 5) + 4 * 3
    assert not got["a"]["budget_ok"] and got["a"]["code"] == 200
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 16
    ok = q.exchange(df, {"a": lambda d: d.write.format("noop").mode("overwrite").save()},
                    rules=q.type_rules({"n": "int"}), limit=0.5).first()
    assert ok["code"] == 0


def test_load_into_files_swaps_versions(spark, tmp_dir):
    schema = "id bigint, v string, seq bigint"
    path = f"{tmp_dir}/table"
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (1, "a2", 3)], schema)
    pol.load_into_files(first, path, "id", "ignore", "seq")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a", 1), (2, "b", 2)]
    second = spark.createDataFrame([(2, "b2", 4), (3, "c", 5), (None, "n", 6)], schema)
    pol.load_into_files(second, path, "id", "replace", "seq")
    got = sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted([(1, "a", 1), (2, "b2", 4), (3, "c", 5), (None, "n", 6)], key=str)
    import os
    assert sorted(os.listdir(tmp_dir)) == ["table"]


def test_load_into_bucketed_files_matches_whole_table_load(spark, tmp_dir):
    t_df, i_df, target, incoming = _policy_fixture(spark)
    path = f"{tmp_dir}/bt"
    first = pol.load_into_bucketed_files(t_df, path, "id", "ignore", "seq", buckets=16)
    assert first and max(first) <= 16
    touched = pol.load_into_bucketed_files(i_df, path, "id", "replace", "seq", buckets=16)
    got = sorted((tuple(r) for r in spark.read.parquet(path).drop(pol.BUCKET_COL).collect()), key=str)
    assert got == brute_policy(target, incoming, "replace")
    # a batch with one key rewrites one bucket only
    one = spark.createDataFrame([(4, "again", 10_000)], "id bigint, v string, seq bigint")
    assert len(pol.load_into_bucketed_files(one, path, "id", "replace", "seq", buckets=16)) == 1
    assert len(touched) <= 17
    import os
    assert sorted(n for n in os.listdir(tmp_dir)) == ["bt"]


def test_exchange_without_char_count(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("n"))
    rep = q.exchange(df, {"a": lambda d: d.write.format("noop").mode("overwrite").save()},
                     measure_chars=False).first()
    assert (rep["rows"], rep["chars"], rep["code"]) == (10, 0, 0)


def test_cell_table_keep_mode_newest_wins(spark, tmp_dir):
    v1 = spark.createDataFrame([("k1", "old", "x")], "key string, a string, b string")
    v2 = spark.createDataFrame([("k1", "new", None), ("k2", "z", None)], "key string, a string, b string")
    path = f"{tmp_dir}/cells"
    cl.write_cells(cl.rows_to_cells(v1, 0, ["f:a", "f:b"], ts=1)[0], path, del_mode=1)
    cl.write_cells(cl.rows_to_cells(v2, 0, ["f:a"], value_index=[1], ts=2)[0], path, del_mode=0)
    rows = cl.cells_to_rows(spark.read.parquet(path), ["f:a", "f:b"], keep_key=True)
    assert sorted(tuple(r) for r in rows.collect()) == [("k1", "new", "x"), ("k2", "z", None)]
    cl.write_cells(cl.rows_to_cells(v2, 0, ["f:a"], value_index=[1], ts=3)[0], path, del_mode=1)
    rows = cl.cells_to_rows(spark.read.parquet(path), ["f:a", "f:b"], keep_key=True)
    assert sorted(tuple(r) for r in rows.collect()) == [("k1", "new", None), ("k2", "z", None)]
    with pytest.raises(ValueError):
        cl.write_cells(cl.rows_to_cells(v1, 0, ["f:a", "f:b"])[0], path, del_mode=7)


def test_exchange_measures_its_own_time(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("n"))
    rep = q.exchange(df, {"a": lambda d: d.write.format("noop").mode("overwrite").save()},
                     seconds="measure").first()
    assert rep["line_speed"].endswith("L/s") and rep["byte_speed"].endswith("B/s")
