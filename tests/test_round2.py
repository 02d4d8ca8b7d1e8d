"""Row loss, replays and swaps: cases that the given tables do not hold."""

import datetime as dt
from decimal import Decimal

import pytest

from loadbay.functions import names
from loadbay.operators import policy, quality
from loadbay.operators.ranges import chunk_predicates
from loadbay.sinks import files as sk
from loadbay.sinks import jdbc as kj
from loadbay.sinks import swap
from loadbay.sources import files as src


def test_null_keys_take_no_part(spark):
    target = spark.createDataFrame([(None, 1, "t")] * 50 + [(1, 1, "t"), (2, 1, "t")], "k int, o int, v string")
    new = spark.createDataFrame([(None, 2, "n"), (2, 2, "n"), (3, 2, "n")], "k int, o int, v string")
    for how, two in (("ignore", "t"), ("replace", "n")):
        out = policy.load_with_key_policy(target, new, "k", how, "o")
        assert "FullOuter" not in out._jdf.queryExecution().toString()
        rows = sorted((r.k, r.v) for r in out.collect() if r.k is not None)
        assert rows == [(1, "t"), (2, two), (3, "n")]
        assert out.where("k is null").count() == 51


def test_bucket_count_is_kept(spark, tmp_dir):
    rows = spark.range(100).selectExpr("id AS k", "1 AS o")
    policy.load_into_bucketed_files(rows, f"{tmp_dir}/t", "k", "replace", "o", buckets=16)
    with pytest.raises(ValueError):
        policy.load_into_bucketed_files(rows, f"{tmp_dir}/t", "k", "replace", "o", buckets=8)
    nulls = spark.createDataFrame([(None, 2)], "k long, o int")
    for _ in range(2):
        policy.load_into_bucketed_files(nulls, f"{tmp_dir}/t", "k", "replace", "o", buckets=16)
    got = spark.read.parquet(f"{tmp_dir}/t")
    assert got.count() == 102 and got.where("k is null").count() == 2


def test_failed_swap_keeps_both(spark, tmp_dir, monkeypatch):
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    monkeypatch.setattr(swap, "_moved", lambda fs, new, live: False)
    with pytest.raises(RuntimeError):
        quality.load_checked(spark.range(9).toDF("id"), {}, 0.5, f"{tmp_dir}/t")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 3


def test_glob_roots(spark, tmp_dir):
    for d in ("aa", "ab", "b"):
        spark.range(1).selectExpr("'x'").write.text(f"{tmp_dir}/{d}/in")
    assert src.expand_paths(spark, f"{tmp_dir}/a*", max_depth=3, pattern="part-*").count() == 2
    assert src.expand_paths(spark, f"{tmp_dir}/{{aa,b}}", max_depth=3, pattern="part-*").count() == 2
    with pytest.raises(ValueError):
        src.expand_paths(spark, f"{tmp_dir}/a*", max_depth=1, pattern="part-*").count()


def test_chunk_bounds():
    ci = [("A", "b"), ("b", "C"), ("C", "d")]  # the order of a case-insensitive database
    assert chunk_predicates(ci, "k") == ["(k < 'b') OR k IS NULL", "k >= 'b' AND k < 'C'", "k >= 'C'"]
    days = chunk_predicates([(dt.date(2024, 1, 1), None), (dt.date(2024, 2, 1), None)], "d")
    assert days == ["(d < '2024-02-01') OR d IS NULL", "d >= '2024-02-01'"]
    assert chunk_predicates([(Decimal("1.50"), None), (Decimal("2"), None)], "n")[1] == "n >= 2"
    with pytest.raises(TypeError):
        chunk_predicates([(b"x", None), (b"y", None)], "k")


def test_load_variables_outside_quotes(spark):
    df = spark.createDataFrame([("1", "v")], "a string, `@p` string")
    assert kj.set_exprs(df, {"b": "concat('x@y', @p)"}).first()["b"] == "x@yv"


def test_files_honour_options(spark, tmp_dir):
    df = spark.createDataFrame([('say "hi"', "a\nb"), ("", "z")], "a string, b string")
    path = sk.write_files(df, tmp_dir, "c", header=["a", "b"], field_split=",")
    text = "".join(open(f"{path}/{f}").read() for f in __import__("os").listdir(path) if f.startswith("part-"))
    assert '"say ""hi"""' in text
    path = sk.write_files(df.select("a"), tmp_dir, "t", file_format="text", header=["a"], compression="gzip")
    assert any(f.endswith(".gz") for f in __import__("os").listdir(path))


def test_explicit_schema_keeps_digits(spark, tmp_dir):
    df = spark.createDataFrame([("12345678901234567.89", "bad")], "a string, b string")
    path = sk.write_parquet_typed(df, tmp_dir, prefix="p", parquet_schema="a decimal(20,2), b timestamp")
    row = spark.read.parquet(path).first()
    assert row.a == Decimal("12345678901234567.89") and row.b is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_do_not_depend_on_the_zone(spark, zone):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from loadbay.functions import dates

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in New York.
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.120' t, '2024-03-10 02:30:05' s, "
                       "'10-MAR-24 02:30:05.5 PM' o, 'March 10' m, '10/13/24' b")
        mask = kj.oracle_mask_to_spark("dd-mon-rr hh12:mi:ss.ff am")
        got = df.select(
            dates.dialect_text(F.col("t"), T.TimestampNTZType(), "mysql"),
            dates.format_ntz("t", "yyMMdd'T'hh:mm a SSS"),
            dates.reformat_date("s", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm"),
            dates.parse_with("o", mask).cast("string"),
            dates.parse_with("m", "MMMM dd").cast("string"),
            dates.parse_with("b", "dd/MM/yy").cast("string")).first()
        assert list(got) == ["2024-03-10 02:30:00", "240310T02:30 AM 120", "2024/03/10 02:30",
                             "2024-03-10 14:30:05.5", "1970-03-10 00:00:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unknown_mask_element():
    with pytest.raises(ValueError):
        kj.oracle_mask_to_spark("yyyy-q")
    assert kj.oracle_mask_to_spark('dd" of "month') == "dd' of 'MMMM"


def test_mixed_folder(spark, tmp_dir):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    for k, compression in enumerate((None, "gzip")):
        sk.write_delimited(df, f"{tmp_dir}/m", prefix=f"t{k}", compression=compression)
    df.write.parquet(f"{tmp_dir}/m/p")
    sk.write_sequence(df, f"{tmp_dir}/m", prefix="s", key_index=0)
    rows = src.read_detected(spark, f"{tmp_dir}/m", num_fields=2).collect()
    assert [tuple(r) for r in rows] == [("a", "b")] * 4


def test_names():
    assert names.expand_pattern("x{1..5..2}y{a..b}") == ["x1ya", "x1yb", "x3ya", "x3yb", "x5ya", "x5yb"]
    assert names.expand_pattern("{0x01..0x03}{nothing}") == ["01{nothing}", "02{nothing}", "03{nothing}"]
    assert names.expand_shards("t_[08-10]x, u") == ["t_08x", "t_09x", "t_10x", "u"]
