"""Loads over several unique keys, versioned file tables, region files, and
text that comes back whole from catalog tables and CSV files."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadbay.operators import regions
from loadbay.operators.policy import load_with_key_policy
from loadbay.operators.unique_keys import load_with_unique_keys
from loadbay.operators.versions import load_version
from loadbay.sinks import manifest as mf

SCHEMA = "a long, b string, c string, v string, seq long"


def _row_by_row(target, incoming, keys, policy):
    """What a database does, one row after the other."""
    def clash(x, y):
        return any(all(x[i] is not None for i in k) and all(x[i] == y[i] for i in k) for k in keys)

    table = list(target)
    for row in sorted(incoming, key=lambda r: r[4]):
        if policy == "ignore":
            if not any(clash(row, t) for t in table):
                table.append(row)
        else:
            table = [t for t in table if not clash(row, t)] + [row]
    return Counter(table)


def _random_rows(seed, n, first, wide):
    rnd = random.Random(seed)
    some = lambda x: None if rnd.random() < 0.1 else x
    return [(some(rnd.randrange(wide)), some(f"k{rnd.randrange(wide)}"), some(rnd.choice(["x", "y", "1:x"])),
             f"v{i}", first + i) for i in range(n)]


@pytest.mark.parametrize("policy", ["ignore", "replace"])
@pytest.mark.parametrize("wide", [12, 60])
def test_two_unique_keys_against_row_by_row(spark, policy, wide):
    keys = [[0], [1, 2]]
    names = [["a"], ["b", "c"]]
    target = list(_row_by_row([], _random_rows(wide, 40, 0, wide), keys, "ignore").elements())
    incoming = _random_rows(wide + 1, 150, 1000, wide)
    got = load_with_unique_keys(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(incoming, SCHEMA).repartition(5),
                                names, policy, "seq")
    assert Counter(tuple(r) for r in got.collect()) == _row_by_row(target, incoming, keys, policy)


@pytest.mark.parametrize("policy", ["ignore", "replace"])
def test_a_chain_of_conflicts(spark, policy):
    # Every row shares one key with the row before and the other with the one after.
    incoming = [((i + 1) // 2, f"k{i // 2}", None, f"v{i}", i) for i in range(12)]
    got = load_with_unique_keys(spark.createDataFrame([], SCHEMA), spark.createDataFrame(incoming, SCHEMA),
                                [["a"], ["b"]], policy, "seq")
    want = _row_by_row([], incoming, [[0], [1]], policy)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert len(want) == (6 if policy == "ignore" else 1)


def test_unique_keys_edge_cases(spark):
    none = spark.createDataFrame([], SCHEMA)
    bare = spark.createDataFrame([(None, None, None, "p", 1), (None, None, None, "p", 1)], SCHEMA)
    assert load_with_unique_keys(none, none, [["a"], ["b"]], "ignore", "seq").count() == 0
    for policy in ("ignore", "replace"):  # no key, no conflict: repeated rows stay
        assert load_with_unique_keys(none, bare, [["a"], ["b"]], policy, "seq").count() == 2
    with pytest.raises(ValueError):
        load_with_unique_keys(none, bare, [["a"]], "merge", "seq")
    with pytest.raises(ValueError):
        load_with_unique_keys(none, bare, [], "ignore", "seq")


def _table(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, seq long")


def _content(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("policy", ["ignore", "replace"])
def test_versions_load_like_the_plain_policy(spark, tmp_dir, policy):
    first = _table(spark, [(i, f"old{i}", 0) for i in range(100)] + [(None, "bare", 0)])
    batch = _table(spark, [(5, "new", 2), (5, "newer", 3), (200, "x", 1), (None, "n1", 1), (None, "n1", 1)])
    root = f"{tmp_dir}/t"
    load_version(first, root, "id", "ignore", "seq", parts=10)
    load_version(batch, root, "id", policy, "seq", epoch=4, writer="w")
    want = _content(load_with_key_policy(first, batch, "id", policy, "seq"))
    assert _content(mf.read_version(spark, root)) == want
    number = mf.current(spark, root).number
    load_version(batch, root, "id", policy, "seq", epoch=4, writer="w")  # a replay changes nothing
    assert mf.current(spark, root).number == number and _content(mf.read_version(spark, root)) == want
    load_version(batch.where("id is null"), root, "id", policy, "seq", epoch=4, writer="other")
    assert mf.read_version(spark, root).count() == sum(want.values()) + 2


def test_a_load_rewrites_only_files_it_meets(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    load_version(_table(spark, [(i, "old", 0) for i in range(1000)]), root, "id", "ignore", "seq", parts=10)
    before = {r["file"] for r in mf.files(spark, mf.current(spark, root)).collect()}
    assert len(before) >= 8
    reader = mf.read_version(spark, root)  # opened before the loads
    load_version(_table(spark, [(-5, "n", 1), (3, "n", 1)]), root, "id", "ignore", "seq")
    added = {r["file"] for r in mf.files(spark, mf.current(spark, root)).collect()}
    assert before < added  # IGNORE only adds
    load_version(_table(spark, [(500, "n", 1)]), root, "id", "replace", "seq")
    after = {r["file"] for r in mf.files(spark, mf.current(spark, root)).collect()}
    assert len(added - after) == 1
    assert reader.count() == 1000 and reader.where("v <> 'old'").count() == 0
    assert mf.read_version(spark, root).where("v = 'n'").count() == 2
    assert mf.remove_unused(spark, root) == 1
    assert mf.read_version(spark, root).count() == 1001


def test_a_failed_or_late_load_changes_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    seen = load_version(_table(spark, [(1, "a", 0)]), root, "id", "ignore", "seq")
    rows = _table(spark, [(2, "b", 0)])
    listed = mf.files(spark, seen).unionByName(mf.add_files(rows, root, "id"))
    assert mf.read_version(spark, root).count() == 1  # files without a version
    mf.publish(spark, seen, listed, "id", rows.schema)
    with pytest.raises(mf.Conflict):
        mf.publish(spark, seen, listed, "id", rows.schema)
    assert mf.read_version(spark, root).count() == 2
    with pytest.raises(ValueError):
        load_version(rows, root, "v", "ignore", "seq")
    with pytest.raises(FileNotFoundError):
        mf.read_version(spark, f"{tmp_dir}/none")


def test_version_sink_replay(spark, tmp_dir):
    from loadbay.streaming.lines import key_policy_sink, version_sink

    batch = _table(spark, [(1, "a", 1), (None, "n", 1)])
    sink = version_sink(f"{tmp_dir}/v", "id", "ignore", "seq")
    plain = key_policy_sink(f"{tmp_dir}/p", "id", "ignore", "seq")
    bucketed = key_policy_sink(f"{tmp_dir}/b", "id", "ignore", "seq", buckets=4)
    for epoch in (0, 0, 1):
        for s in (sink, plain, bucketed):
            s(batch, epoch)
    want = Counter({(1, "a", 1): 1, (None, "n", 1): 2})
    assert _content(mf.read_version(spark, f"{tmp_dir}/v")) == want
    assert _content(spark.read.parquet(f"{tmp_dir}/p")) == want
    assert _content(spark.read.parquet(f"{tmp_dir}/b").drop("_bucket")) == want


def _cells(spark, n, ts):
    return spark.range(n).select(
        F.format_string("row%05d", F.col("id") % 300).alias("rowkey"), F.lit("f").alias("family"),
        (F.col("id") % 2).cast("string").alias("qualifier"), (F.col("id") + ts).alias("ts"),
        F.concat(F.lit("v"), F.col("id") + ts).alias("value"))


def test_regions(spark, tmp_dir):
    root = f"{tmp_dir}/cells"
    one, two = _cells(spark, 1200, 0), _cells(spark, 600, 5000)
    regions.write_regions(one, root, del_mode=1, regions=8)
    regions.write_regions(two, root, del_mode=0, regions=4)
    both = one.unionByName(two)
    in_range = (F.col("rowkey") >= "row00050") & (F.col("rowkey") < "row00060")
    assert _content(regions.region_scan(spark, root, "row00050", "row00060")) == _content(both.where(in_range))
    scan = regions.region_scan(spark, root, "row00050", "row00060")
    opened = scan.inputFiles()
    assert 0 < len(opened) <= 4 < regions.region_index(spark, root).count()
    regions.compact_regions(spark, root, regions=6)
    newest = both.groupBy("rowkey", "family", "qualifier").agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
    assert _content(regions.region_scan(spark, root)) == _content(newest.select(*regions.COLUMNS))
    index = regions.region_index(spark, root).orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(index, index[1:]))
    files = [tuple(r) for r in spark.read.parquet(f"{root}/{index[0]['file']}").collect()]
    assert files == sorted(files, key=lambda r: (r[0], r[1], r[2], r[3]))
    with pytest.raises(ValueError):
        regions.region_scan(spark, root, "b", "a")
    regions.write_regions(one.where("rowkey = 'row00001'"), root, del_mode=1)
    assert regions.region_scan(spark, root).count() == 4


def test_compaction_keeps_several_versions(spark, tmp_dir):
    root = f"{tmp_dir}/cells"
    rows = [("r", "f", "q", t, f"v{t}") for t in (1, 5, 3)] + [("r", "f", "q", None, "old"), (None, "f", "q", 1, "x")]
    regions.write_regions(spark.createDataFrame(rows, "rowkey string, family string, qualifier string, ts long, value string"),
                          root)
    regions.compact_regions(spark, root, versions=2)
    assert sorted(r["value"] for r in regions.region_scan(spark, root).collect()) == ["v3", "v5"]


TEXTS = ["  lead", "trail  ", "", 'say "hi"', '"', "a\\b", "\\", "#c", "plain", "tab\there", " ", None, "\x01", "x\ny", "'q'"]


def test_catalog_text_comes_back(spark, tmp_dir):
    from loadbay.sinks.catalog import load_hive
    from loadbay.sources.catalog import read_hive_location

    df = spark.createDataFrame([(str(i), t, "z") for i, t in enumerate([*TEXTS, "\\N"])], "k string, t string, z string")
    spark.sql("DROP TABLE IF EXISTS lb_text_tbl")
    load_hive(df, "lb_text_tbl", {"ds": "007"}, location=f"{tmp_dir}/tbl")
    back = read_hive_location(spark, "", "lb_text_tbl", {"ds": "007"})
    assert back.columns == ["k", "t", "z", "ds"]
    got = {int(r["k"]): (r["t"], r["z"], r["ds"]) for r in back.collect()}
    want = [t if t is None else t.replace("\x01", " ").replace("\n", " ") for t in TEXTS] + [None]  # \N reads as NULL
    assert got == {i: (t, "z", "007") for i, t in enumerate(want)}
    # Spark's own reader differs in empty text only.
    sql = {int(r["k"]): r["t"] for r in spark.table("lb_text_tbl").collect()}
    assert sql == {i: t or None for i, t in enumerate(want)}
    spark.sql("DROP TABLE lb_text_tbl")


def test_csv_text_comes_back(spark, tmp_dir):
    from loadbay.sinks.files import write_files

    texts = [t for t in TEXTS if t is not None and "\n" not in t] + ["x,y"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate([*texts, None])], "k string, t string")
    path = write_files(df, f"{tmp_dir}/csv", header=["k", "t"], field_split=",", empty_text='""')
    back = (spark.read.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false").option("nullValue", "\\N").schema("k string, t string").csv(path))
    assert {int(r["k"]): r["t"] for r in back.collect()} == dict(enumerate([*texts, None]))
    trimmed = write_files(df.where("k = '0'"), f"{tmp_dir}/csv2", field_split=",", trim=True)
    assert spark.read.text(trimmed).first()[0] == "0,lead"


def test_numbered_files_are_recognised(spark, tmp_dir):
    from loadbay.plans.transfers import _file_prefix
    from loadbay.sinks.files import write_delimited
    from loadbay.sources.files import read_delimited

    for parts in (1, 3):
        df = spark.range(30).repartition(parts).select(F.col("id").cast("string"))
        path = write_delimited(df, f"{tmp_dir}/{parts}", prefix="some-2", number_files=True)
        rows = read_delimited(spark, path, num_fields=1, with_file=True)
        assert {r[0] for r in rows.select(_file_prefix("_file")).distinct().collect()} == {"some-2"}
