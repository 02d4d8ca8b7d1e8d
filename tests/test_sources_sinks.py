"""Sources and sinks: fixtures from FIXTURES.md, round trips, quirks."""

import bz2
import gzip
import os

import pytest
from pyspark.sql import functions as F

from loadbay.sinks import catalog as kc
from loadbay.sinks import files as sk
from loadbay.sinks import jdbc as kj
from loadbay.sources import catalog as rc
from loadbay.sources import files as src
from loadbay.sources import generate as gen
from loadbay.sources import http as hp
from loadbay.sources import jdbc as rj
from loadbay.sources import shards as sh

from conftest import SF_SMALL


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as fh:
        fh.write(text)


def test_delimited_fixture(spark, tmp_dir):
    # nation as key\tname\tregion plus an empty line, trailing empties,
    # a short row and a \N marker
    write(f"{tmp_dir}/delim_tab/part.txt",
          "0\tALGERIA\t0\n\n1\tARGENTINA\t\t\n2\tBRAZIL\n3\t\\N\t1\r\n")
    rows = src.read_delimited(spark, f"{tmp_dir}/delim_tab", field_split="\t",
                              null_string="", num_fields=4).collect()
    got = sorted((tuple(r) for r in rows), key=str)
    assert got == sorted([("0", "ALGERIA", "0", None), (None, None, None, None),
                          ("1", "ARGENTINA", None, None), ("2", "BRAZIL", None, None),
                          ("3", "\\N", "1", None)], key=str)
    mapped = src.read_delimited(spark, f"{tmp_dir}/delim_tab", field_split="\t",
                                null_string="\\N", col_filter="#1,#0,x").collect()
    assert ("ALGERIA", "0", "x") in [tuple(r) for r in mapped]
    assert (None, "3", "x") in [tuple(r) for r in mapped]
    arr = src.read_delimited(spark, f"{tmp_dir}/delim_tab", field_split="\t", null_string=None)
    assert arr.columns == ["fields"]
    assert sorted(len(r[0]) for r in arr.collect()) == [1, 2, 3, 3, 4]


def test_compressed_by_suffix(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/c")
    with gzip.open(f"{tmp_dir}/c/a.gz", "wt") as fh:
        fh.write("1|x\n2|y\n")
    with bz2.open(f"{tmp_dir}/c/b.bz2", "wt") as fh:
        fh.write("3|z\n")
    rows = src.read_delimited(spark, f"{tmp_dir}/c", field_split="|", num_fields=2).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_delimited_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a\tb\nc", None), (2, "", "z")], "id int, t string, u string")
    path = sk.write_delimited(df, tmp_dir, prefix="out", field_split="\t", compression="bzip2",
                              file_count=2)
    assert any(f.endswith(".bz2") for f in os.listdir(path))
    back = src.read_delimited(spark, path, field_split="\t", num_fields=3).collect()
    assert sorted(tuple(r) for r in back) == [("1", "a b c", None), ("2", None, "z")]
    with pytest.raises(Exception):
        sk.write_delimited(df, tmp_dir, prefix="out", del_mode=1)
    sk.write_delimited(df, tmp_dir, prefix="other", del_mode=4)
    assert os.listdir(tmp_dir) == ["other"]


def test_sequence_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("k1", "a", None), ("k2", "", "c")], "k string, a string, b string")
    path = sk.write_sequence(df, tmp_dir, prefix="seq", key_index=0)
    with_key = src.read_sequence(spark, path, ignore_key=False, num_fields=3).collect()
    assert sorted(tuple(r) for r in with_key) == [("k1", "a", None), ("k2", None, "c")]
    no_key = src.read_sequence(spark, path, num_fields=2).collect()
    assert sorted((tuple(r) for r in no_key), key=str) == sorted([("a", None), (None, "c")], key=str)
    nullkey = sk.write_sequence(df, tmp_dir, prefix="seq2")
    rows = src.read_sequence(spark, nullkey, ignore_key=False, num_fields=3).collect()
    assert sorted(tuple(r) for r in rows) == [("k1", "a", None), ("k2", None, "c")]


def test_parquet_typed_sink(spark, tmp_dir):
    df = spark.createDataFrame([("1", "2.5", "x", "9999999999", "")],
                               "a string, b string, c string, `t.d` string, e string")
    path = sk.write_parquet_typed(df, tmp_dir, ["int", "decimal(10,2)", "string", "bigint", "int"])
    back = spark.read.parquet(path)
    assert back.columns == ["a", "b", "c", "t", "e"]
    assert tuple(back.first()) == (1, 2.5, "x", 9999999999, None)


def test_detect_format(spark, tmp_dir):
    df = spark.range(5).select(F.col("id").cast("string").alias("v"))
    sk.write_delimited(df, tmp_dir, prefix="txt")
    sk.write_delimited(df, tmp_dir, prefix="gz", compression="gzip")
    df.write.parquet(f"{tmp_dir}/pq")
    sk.write_sequence(df, tmp_dir, prefix="seq")
    write(f"{tmp_dir}/magic/noext", "PAR1xxxx", "w")
    kinds = {}
    for r in src.detect_format(spark, tmp_dir).collect():
        name = os.path.basename(r["path"])
        if name.startswith((".", "_")):
            continue
        kinds.setdefault(r["path"].split("/")[-2], set()).add(r["kind"])
    assert kinds["txt"] == {"TXT"} and kinds["gz"] == {"COMP_TXT"}
    assert kinds["pq"] == {"PARQUET"} and kinds["seq"] == {"SEQ"}
    assert kinds["magic"] == {"PARQUET"}


def test_expand_paths_depth(spark, tmp_dir):
    write(f"{tmp_dir}/a.txt", "1")
    write(f"{tmp_dir}/d1/b.txt", "2")
    write(f"{tmp_dir}/d1/d2/c.txt", "3")
    write(f"{tmp_dir}/d1/d2/c.csv", "3")
    files = src.expand_paths(spark, tmp_dir, max_depth=2, pattern="*.txt", on_too_deep="skip")
    assert sorted(os.path.basename(r["path"]) for r in files.collect()) == ["a.txt", "b.txt"]
    with pytest.raises(ValueError):
        src.expand_paths(spark, tmp_dir, max_depth=2, on_too_deep="error")


def test_partition_read(spark, tmp_dir):
    write(f"{tmp_dir}/parts/pt=20160101/hour=01/a.txt", "1\tx\n")
    write(f"{tmp_dir}/parts/pt=20160101/hour=02/a.txt", "2\ty\n")
    write(f"{tmp_dir}/parts/pt=20160102/hour=01/a.txt", "3\tz\n")
    rows = src.read_partition(spark, f"{tmp_dir}/parts", ["pt", "hour"], ["20160101", None],
                              num_fields=2).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "x", "20160101", "01"), ("2", "y", "20160101", "02")]
    assert src.partition_path("/r", ["pt", "hour"], ["1", "2"]) == "/r/pt=1/hour=2"
    with pytest.raises(ValueError):
        src.read_partition(spark, f"{tmp_dir}/parts", ["pt", "hour"], ["20160101"])


def test_remote_text_header_per_file(spark, tmp_dir):
    write(f"{tmp_dir}/ftp/a.txt", "h1\x01h2\n1\x01\\N\n\n2\x01b\n")
    write(f"{tmp_dir}/ftp/b.txt", "h1\x01h2\n3\x01\\N\n")
    rows = src.read_remote_text(spark, f"file://{tmp_dir}/ftp", skip_header=True, num_fields=2).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(
        [("1", None), ("", None), ("2", "b"), ("3", None)], key=str)
    legacy = src.read_remote_text(spark, f"file://{tmp_dir}/ftp", skip_header=True, num_fields=2,
                                  legacy_last_field=True).collect()
    assert ("1", "\\N") in [tuple(r) for r in legacy]


def test_csv_files_with_user_header(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (None, None)], "k int, v string")
    path = sk.write_files(df.repartition(3), tmp_dir, prefix="csv", header=["key", "val"],
                          field_split=",")
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["key", "val"]
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted([("1", "a,b"), ("2", None)], key=str)
    text = sk.write_files(df, tmp_dir, prefix="txt", file_format="text", header=["key", "val"],
                          field_split="\t")
    lines = [r[0] for r in spark.read.text(text).collect()]
    assert lines.count("key\tval") >= 1 and "1\ta,b" in lines
    with pytest.raises(ValueError):
        sk.write_files(df, tmp_dir, write_mode="sometimes")
    with pytest.raises(ValueError):
        sk.write_files(df, tmp_dir, must_contain="never-there")


def test_schema_sidecar(spark, tmp_dir):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = sk.write_with_schema(o.toDF(*[c.upper() for c in o.columns]), f"{tmp_dir}/ws")
    back = sk.read_with_schema(spark, path)
    assert back.columns == o.columns and back.dtypes == o.dtypes
    assert back.exceptAll(o).count() == 0 and o.exceptAll(back).count() == 0


def test_format_rows(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert sk.format_rows(df, "|", ">", "NULL").first()[0] == ">1|NULL"
    assert sk.print_rows(df, print_=False) == 1


def test_http_bodies(spark):
    bodies = {"u1": "a,b,,\nc\n", "u2": "", "u3": ",,\n\\N,x"}
    rows = hp.read_http(spark, "u1; u2 ;u3", bodies.get, field_split=",", null_string="\\N").collect()
    got = sorted((r["url"], r["line_no"], tuple(r["fields"])) for r in rows)
    assert got == [("u1", 0, ("a", "b")), ("u1", 1, ("c",)), ("u3", 0, ()), ("u3", 1, (None, "x"))]


def test_constant_rows(spark):
    df = gen.constant_rows(spark, 7, "x", field_num=2, num_partitions=3)
    assert df.count() == 7 and df.first()[0] == "x" and len(df.columns) == 2
    assert gen.constant_rows(spark, 3, "x").columns == []


def test_shards(spark, tmp_dir):
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).write.parquet(f"{tmp_dir}/t_{i:02d}")
    df = sh.read_sharded_files(spark, tmp_dir, "t_[00-02]", with_shard=True)
    assert df.count() == 30
    assert sorted(r[0] for r in df.select("_shard").distinct().collect()) == ["t_00", "t_01", "t_02"]
    df2 = sh.read_sharded(spark, lambda n: spark.read.parquet(f"{tmp_dir}/{n}"), "t_[0-2]".replace(
        "[0-2]", "[00-02]"), with_shard=True)
    assert df2.count() == 30
    assert sh.shard_names("a_{1..3}") == ["a_1", "a_2", "a_3"]


def test_catalog_load_and_statements(spark, tmp_dir):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    kc.load_hive(df, "lb_test_tbl", {"ds": "20240101"}, location=f"{tmp_dir}/tbl",
                 pre="DROP TABLE IF EXISTS lb_test_tbl")
    kc.load_hive(df, "lb_test_tbl", {"ds": "20240102"})
    back = rc.read_hive_location(spark, "", "lb_test_tbl", {"ds": "20240102"}).collect()
    assert [tuple(r) for r in back] == [("1", "x", "20240102")]
    assert rc.read_query(spark, tables="lb_test_tbl", columns="a", where="ds = '20240101'").count() == 1
    assert kc.split_statements("a; b ';' c ;; d") == ["a", "b ';' c", "d"]
    assert rc.warehouse_location("db", "t", "/w") == "/w/db.db/t"


def test_route_shards(spark, tmp_dir):
    df = spark.createDataFrame([(1, "orders_01"), (2, "orders_02"), (3, "users7")], "id int, src string")
    kc.route_shards(df, "src", f"{tmp_dir}/r")
    names = os.listdir(f"{tmp_dir}/r")
    assert "target=s_orders" in names and "target=s_users" in names


def test_jdbc_sql_generation():
    assert rj.table_sql("t", ["a", "b"], "a > 1", schema="s") == "SELECT a, b FROM s.t WHERE a > 1"
    assert rj.clean_sql(" select 1 ; ") == "select 1"
    assert "NTILE(200)" in rj.ntile_bounds_sql("t", "id")
    assert rj.jdbc_url("postgres", "h", "d") == "jdbc:postgresql://h:5432/d"
    assert rj.DIALECTS["oracle"]["fetchsize"] == "500"


def test_map_columns_and_set(spark):
    df = spark.createDataFrame([("1", "2.5", "z")], "a string, b string, c string")
    mapped = kj.map_columns(df, ["id", "@p", "name"], ["id", "name", "cents", "other"])
    out = kj.set_exprs(mapped, "cents = cast(@p as double) * 100", ["id", "name", "cents", "other"])
    assert out.columns == ["id", "name", "cents", "other"]
    assert tuple(out.first()) == ("1", "z", 250.0, None)
    ascii_ = kj.map_columns(df, "ascii", ["z", "a", "m"])
    assert ascii_.columns == ["a", "m", "z"]
    with pytest.raises(ValueError):
        kj.map_columns(df, ["nope"], ["id"])


def test_parquet_explicit_schema(spark, tmp_dir):
    df = spark.createDataFrame([("7", " 2.5 ", "")], "a string, b string, c string")
    path = sk.write_parquet_typed(df, tmp_dir, parquet_schema="id bigint, price double, note string")
    back = spark.read.parquet(path)
    assert back.dtypes == [("id", "bigint"), ("price", "double"), ("note", "string")]
    assert tuple(back.first()) == (7, 2.5, None)


def test_partition_dir_not_name_value_is_an_error(spark, tmp_dir):
    write(f"{tmp_dir}/p/pt=1/hour=01/a.txt", "1\tx\n")
    write(f"{tmp_dir}/p/pt=1/bad/a.txt", "2\ty\n")
    with pytest.raises(Exception):
        src.read_partition(spark, f"{tmp_dir}/p", ["pt", "hour"], None, num_fields=2).collect()


def test_number_part_files(spark, tmp_dir):
    df = spark.range(30).select(F.col("id").cast("string").alias("v"))
    path = sk.write_delimited(df, tmp_dir, prefix="load", file_count=3, compression="gzip",
                              number_files=True)
    names = sorted(n for n in os.listdir(path) if not n.startswith((".", "_")))
    assert names == ["load-0.txt.gz", "load-1.txt.gz", "load-2.txt.gz"]
    assert src.read_delimited(spark, path, num_fields=1).count() == 30


def test_print_rows_prints_every_row(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("v"), F.lit(None).cast("string"))
    assert sk.print_rows(df, "|", "> ", "NULL") == 5


def test_remote_text_header_with_split_files(spark, tmp_dir):
    # files larger than the split size: later splits must keep their lines
    body = "".join(f"{i}\x01v{i}\n" for i in range(20000))
    write(f"{tmp_dir}/big/a.txt", "h1\x01h2\n" + body)
    write(f"{tmp_dir}/big/b.txt", "h1\x01h2\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        rows = src.read_remote_text(spark, f"{tmp_dir}/big", skip_header=True, num_fields=2)
        assert rows.count() == 40000
        assert rows.filter("_c0 = 'h1'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_list_remote_rules(spark, tmp_dir):
    write(f"{tmp_dir}/r/a.txt", "1")
    write(f"{tmp_dir}/r/b.csv", "2")
    write(f"{tmp_dir}/r/d/c.txt", "3")
    got = sorted(os.path.basename(r["path"]) for r in src.list_remote(spark, f"{tmp_dir}/r/*.txt").collect())
    assert got == ["a.txt", "c.txt"]
    with pytest.raises(ValueError):
        src.list_remote(spark, f"{tmp_dir}/*/a.txt")
    with pytest.raises(ValueError):
        src.list_remote(spark, f"{tmp_dir}/r", max_depth=1)


def test_del_modes_and_write_modes(spark, tmp_dir):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    count = lambda p: spark.read.text(p).count()
    p = sk.write_delimited(df, tmp_dir, prefix="x", del_mode=3)
    assert count(p) == 2
    sk.write_delimited(df, tmp_dir, prefix="x", del_mode=0)       # overwrite same name
    assert count(p) == 2
    sk.write_delimited(df, tmp_dir, prefix="x", write_mode="append")
    assert count(p) == 4
    with pytest.raises(Exception):
        sk.write_delimited(df, tmp_dir, prefix="x", write_mode="nonConflict")
    sk.write_delimited(df, tmp_dir, prefix="y", del_mode=2)
    assert sorted(os.listdir(tmp_dir)) == ["x", "y"]
    sk.write_delimited(df, tmp_dir, prefix="z", del_mode=4)     # clears the folder first
    assert os.listdir(tmp_dir) == ["z"]
    with pytest.raises(ValueError):
        sk.write_delimited(df, tmp_dir, prefix="w", del_mode=9)


def test_oracle_positional_masks(spark):
    assert kj.oracle_mask_to_spark("yyyy-mm-dd hh24:mi:ss") == "yyyy-MM-dd HH:mm:ss"
    assert kj.oracle_mask_to_spark("yyyymmdd.ff") == "yyyyMMdd.SSSSSSSSS"
    assert kj.positional_date_masks(["varchar", "date", "timestamp", "date"], "yyyymmdd,yyyy-mm-dd") == [
        None, "yyyymmdd", "yyyy-mm-dd.ff", "yyyymmdd"]
    assert kj.positional_date_masks(["date"], None) == ["yyyy-mm-dd"]
    import datetime as dt
    df = spark.createDataFrame([("a\x01b", "20240305", "2024-03-05.123")], "s string, d string, t string")
    row = kj.prepare_rows_with_masks(df, ["varchar", "date", "timestamp"], "yyyymmdd,yyyy-mm-dd").first()
    assert row[0] == "ab" and row[1] == dt.datetime(2024, 3, 5)
    assert row[2] == dt.datetime(2024, 3, 5, 0, 0, 0, 123000)


def test_load_file_escaping(spark, tmp_dir):
    df = spark.createDataFrame([("a\\b", None, "x\x01y\x02z\n"), ("\\N", "", "end\\")], "a string, b string, c string")
    path = kj.write_load_file(df, f"{tmp_dir}/lf", "mysql")
    raw = b"".join(open(os.path.join(path, f), "rb").read()
                   for f in sorted(os.listdir(path)) if f.startswith("part-"))
    assert b"\\N" in raw and b"a\\\\b" in raw
    back = sorted((tuple(r) for r in kj.read_load_file(spark, path, 3).collect()), key=str)
    assert back == sorted([("a\\b", None, "xyz\n"), ("\\N", "", "end\\")], key=str)


@pytest.mark.parametrize("kind", ["RECORD", "BLOCK"])
def test_sequence_compressed(spark, tmp_dir, kind):
    df = spark.createDataFrame([(str(i), f"v{i}", None) for i in range(50)], "k string, a string, b string")
    path = sk.write_sequence(df, tmp_dir, prefix=kind, key_index=0, compression=kind)
    rows = src.read_sequence(spark, path, ignore_key=False, num_fields=3).collect()
    assert sorted(tuple(r) for r in rows) == sorted((str(i), f"v{i}", None) for i in range(50))


def test_csv_empty_text_written_as_nothing(spark, tmp_dir):
    df = spark.createDataFrame([("a", ""), ("b", None)], "k string, v string").coalesce(1)
    path = sk.write_files(df, tmp_dir, prefix="e", header=["k", "v"], field_split=",")
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert sorted(lines) == ["a,", "b,", "k,v"]


def test_read_detected_picks_reader_and_refuses_mixed_folders(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "k string, v string")
    sk.write_sequence(df, tmp_dir, prefix="seq", key_index=0)
    rows = sorted(tuple(r) for r in src.read_detected(spark, f"{tmp_dir}/seq", num_fields=2).collect())
    assert rows == [("1", "a"), ("2", None)]
    df.write.parquet(f"{tmp_dir}/mixed/pq")
    sk.write_delimited(df, f"{tmp_dir}/mixed", prefix="txt")
    with pytest.raises(ValueError):
        src.read_detected(spark, f"{tmp_dir}/mixed")


def test_numbered_files_follow_the_input(spark, tmp_dir, monkeypatch):
    from loadbay.plans import transfers
    from loadbay.sinks import files

    made, write = [], files.write_delimited
    monkeypatch.setattr(transfers.sinks, "write_delimited", lambda *a, **k: made.append(write(*a, **k)) or made[-1])
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    monkeypatch.setattr(transfers, "table", lambda spark, sf_dir, name: orders.repartition(11))
    assert transfers.numbered_files(spark, tmp_dir).count() == orders.count()
    count = lambda path: spark.read.text(path).select("_metadata.file_path").distinct().count()
    assert count(made[-1]) == 11
    path = write(orders, f"{tmp_dir}/three", prefix="o", file_count=3, number_files=True)
    assert count(path) == 3 and spark.read.text(path).count() == orders.count()
