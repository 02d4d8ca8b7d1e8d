"""Unit cases for the row rules (P1-P18): each quirk, hand-derived."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadbay.functions import dates as D
from loadbay.functions import names as N
from loadbay.functions import text as tx


def one(spark, value, expr_fn, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr_fn(F.col(df.columns[0])).alias("r")).first()["r"]


def test_parse_char_option():
    assert tx.parse_char_option("\\t") == "\t"
    assert tx.parse_char_option("\\001") == "\x01"
    assert tx.parse_char_option("\\009") == "\t"
    assert tx.parse_char_option("|") == "|"
    assert tx.parse_char_option(None) == "\x01"
    # \uNNNN is read as a decimal code
    assert tx.parse_char_option("\\u0044") == chr(44)
    with pytest.raises(ValueError):
        tx.parse_char_option("ab")


def test_split_line_keeps_empties(spark):
    assert one(spark, "a,,b,,", lambda c: tx.split_line(c, ",")) == ["a", "", "b", "", ""]
    assert one(spark, "", lambda c: tx.split_line(c, ",")) == [""]
    # regex metacharacters are literal
    assert one(spark, "a|b.c", lambda c: tx.split_line(c, "|")) == ["a", "b.c"]
    assert one(spark, "a.b", lambda c: tx.split_line(c, ".")) == ["a", "b"]
    assert one(spark, "a\\b", lambda c: tx.split_line(c, "\\")) == ["a", "b"]


def test_split_line_regex_drops_trailing_empties(spark):
    assert one(spark, "a,,b,,", lambda c: tx.split_line_regex(c, ",")) == ["a", "", "b"]
    assert one(spark, "", lambda c: tx.split_line_regex(c, ",")) == [""]
    assert one(spark, ",,,", lambda c: tx.split_line_regex(c, ",")) == []
    assert one(spark, ",a", lambda c: tx.split_line_regex(c, ",")) == ["", "a"]


def test_split_lines(spark):
    assert one(spark, "a\nb\n", tx.split_lines) == ["a", "b"]
    assert one(spark, "a\r\n\rb", tx.split_lines) == ["a", "", "b"]
    assert one(spark, "", tx.split_lines) == []
    assert one(spark, "\n", tx.split_lines) == [""]


def test_null_map_fields_and_last_field(spark):
    arr = F.array(F.lit("\\N"), F.lit("x"), F.lit("\\N"))
    df = spark.range(1)
    assert df.select(tx.null_map_fields(arr, "\\N")).first()[0] == [None, "x", None]
    assert df.select(tx.null_map_fields(arr, "\\N", keep_last=True)).first()[0] == [None, "x", "\\N"]


def test_col_filter(spark):
    df = spark.createDataFrame([(["a", "", "c"],)], "f array<string>")
    row = df.select(*tx.col_filter("f", "#2,#0,k,null,#7,#1", null_string="")).first()
    assert tuple(row) == ("c", "a", "k", "", None, None)
    # legacy: an index named twice fills only its last position
    row = df.select(*tx.col_filter("f", "#0,#0", legacy_duplicate_index=True)).first()
    assert tuple(row) == (None, "a")
    row = df.select(*tx.col_filter("f", "#0,#0")).first()
    assert tuple(row) == ("a", "a")


def test_fit_arity(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "f array<string>")
    assert df.select(tx.fit_arity("f", 2)).first()[0] == ["a", "b"]
    assert df.select(tx.fit_arity("f", 5)).first()[0] == ["a", "b", "c", None, None]
    assert df.select(tx.fit_arity("f", 0)).first()[0] == []


def test_sanitize_and_escape(spark):
    assert one(spark, "a\x01b\nc\rd", lambda c: tx.sanitize_hdfs(c, "\x01")) == "a b c d"
    assert one(spark, "a;b", lambda c: tx.sanitize_hdfs(c, "\x01", line_split=";")) == "a b"
    assert one(spark, None, lambda c: tx.sanitize_hdfs(c, "\x01")) is None
    assert one(spark, "a\x01b\x02c", tx.sanitize_load) == "abc"
    assert one(spark, "a\\b\x01", tx.escape_load) == "a\\\\b"
    assert one(spark, None, tx.escape_load) == "\\N"
    assert one(spark, None, lambda c: tx.null_out(c, "NULL")) == "NULL"


def test_typed_by_hive(spark):
    df = spark.createDataFrame([("+12", "", "x", " 1.5 ", None, "abc")],
                               "a string, b string, c string, d string, e string, f string")
    out = tx.typed_by_hive(df, {"a": "int", "b": "bigint", "c": "double", "d": "decimal(10,2)",
                                "e": "int", "f": "varchar(10)"})
    assert tuple(out.first()) == (12, None, None, 1.5, None, "abc")
    assert dict(out.dtypes) == {"a": "int", "b": "bigint", "c": "double", "d": "double",
                                "e": "int", "f": "string"}
    bad = df.select(tx.bad_cast("c", "double"), tx.bad_cast("b", "int"), tx.bad_cast("a", "int"))
    assert tuple(bad.first()) == (True, False, False)


def test_integer_text_is_strict(spark):
    # Integers: sign and digits only (no blanks, no fraction); out of range
    # is bad.  Floating point text may carry blanks.
    df = spark.createDataFrame([(" 12",), ("12 ",), ("1.0",), ("-7",), ("99999999999",), (" ",)], "s string")
    got = [tuple(r) for r in df.select(tx.typed_column("s", "int"), tx.bad_cast("s", "int"),
                                       tx.typed_column("s", "double")).collect()]
    assert got == [(None, True, 12.0), (None, True, 12.0), (None, True, 1.0), (-7, False, -7.0),
                   (None, True, 99999999999.0), (None, True, None)]


def test_to_text_rows_arrays_last_element(spark):
    df = spark.createDataFrame([([1.5, 2.5], 3, None)], "a array<double>, b int, c string")
    assert tuple(tx.to_text_rows(df, "").first()) == ("2.5", "3", None)


def test_row_length(spark):
    df = spark.createDataFrame([("ab", None, 123)], "a string, b string, c int")
    assert df.select(tx.row_length(["a", "b", "c"])).first()[0] == 5


def test_gbk_decode_encode(spark, tmp_dir):
    text = "中文\x01测试"
    path = f"{tmp_dir}/gbk.txt"
    with open(path, "wb") as fh:
        fh.write((text + "\n" + "你好\x01x\n").encode("gbk"))
    from loadbay.sources.files import read_delimited

    rows = read_delimited(spark, path, field_split="\x01", encoding="GBK", num_fields=2).collect()
    assert sorted(tuple(r) for r in rows) == sorted([("中文", "测试"),
                                                     ("你好", "x")])


# ---------------------------------------------------------------- dates

def test_parse_dates_rules(spark):
    cases = {
        "20240229": dt.datetime(2024, 2, 29),
        "2024-02-29": dt.datetime(2024, 2, 29),
        "20230229": None,                       # impossible date
        "12:30:01": dt.datetime(1970, 1, 1, 12, 30, 1),
        "20240131 23:59:59": dt.datetime(2024, 1, 31, 23, 59, 59),
        "2024-01-31 23:59:59": dt.datetime(2024, 1, 31, 23, 59, 59),
        "  20240131  ": None,                   # length 12 > 11: date-time group
        " 20240131 ": dt.datetime(2024, 1, 31),  # length 10: date group, trimmed
        "\t2024-01-31": dt.datetime(2024, 1, 31),
        "2024-1-31": None,
        "20241301": None,
        "garbage": None,
        "": None,
        "24:00:00": None,
        "12:60:00": None,
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    got = {r["s"]: r["p"] for r in df.select("s", D.parse_dates("s").alias("p")).collect()}
    for k, v in cases.items():
        assert got[k] == v, k
    assert got[None] is None


def test_parse_dates_masks(spark):
    df = spark.createDataFrame([("2024/03/05",), ("05.03.2024",)], "s string")
    out = df.select(D.parse_dates("s", masks=("yyyy/MM/dd", "dd.MM.yyyy"))).collect()
    assert [r[0] for r in out] == [dt.datetime(2024, 3, 5), dt.datetime(2024, 3, 5)]


def test_reformat_date(spark):
    df = spark.createDataFrame([("2024-03-05 10:11:12",), ("",), (None,), ("bad",)], "s string")
    out = df.select(D.reformat_date("s", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd"),
                    D.timestamp_to_date("s", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm")).collect()
    assert [tuple(r) for r in out] == [("20240305", "2024/03/05"), ("", ""), ("", ""), ("", "")]


def test_dates_to_text_dialects(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 5), dt.datetime(2024, 3, 5, 1, 2, 3, 456789), 7)],
                               "d date, ts timestamp_ntz, n int")
    assert tuple(D.dates_to_text(df, "oracle").first()) == (
        "2024-03-05 00:00:00", "2024-03-05 01:02:03", "7")
    assert tuple(D.dates_to_text(df, "mysql").first()) == (
        "2024-03-05", "2024-03-05 01:02:03", "7")


# ---------------------------------------------------------------- names

def test_expand_shards():
    assert N.expand_shards("t_[00-03]") == ["t_00", "t_01", "t_02", "t_03"]
    assert N.expand_shards("t[3-1]x, u") == ["t1x", "t2x", "t3x", "u"]
    assert N.expand_shards("t[08-10]") == ["t08", "t09", "t10"]


def test_expand_pattern():
    assert N.expand_pattern("x{1..5..2}y") == ["x1y", "x3y", "x5y"]
    assert N.expand_pattern("{a..c}") == ["a", "b", "c"]
    assert N.expand_pattern("{0x08..0x0b}") == ["08", "09", "0a", "0b"]
    assert N.expand_pattern("{1..2}_{a..b}") == ["1_a", "1_b", "2_a", "2_b"]
    assert N.expand_pattern("{01..10}")[:2] == ["01", "02"]


def test_work_date_macros():
    assert N.work_date_macros("t_{yyyymmdd}_{v_month_first}", "20240315") == "t_20240315_20240301"


def test_route_shard_name(spark):
    df = spark.createDataFrame([("Orders_07",), ("users12",), ("x",)], "t string")
    out = [r[0] for r in df.select(N.route_shard_name("t")).collect()]
    assert out == ["s_orders", "s_users", "s_x"]
