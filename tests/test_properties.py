"""Property checks: the Column rules against plain-Python statements of the
same rules, on many random inputs evaluated in one Spark job each; and the
write -> read round trip of the delimited sink and source."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from loadbay.functions import dates as D
from loadbay.functions import text as tx
from loadbay.sinks import files as sk
from loadbay.sources import files as src

ALPHABET = ["a", "b", ",", ";", "\t", " ", "\x01", "\\", "é", "中", ""]


def random_texts(seed, n=400, max_len=12):
    rnd = random.Random(seed)
    out = ["", ",", ",,", "a,", ",a"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len))))
    return out


def py_split_regex(s, regex):
    """Java ``String.split(regex)``: trailing empty strings removed; an
    input without any match (the empty input included) is returned whole."""
    if s == "":
        return [""]
    parts = re.split(regex, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_split_line_matches_python(spark):
    texts = random_texts(1)
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for sep in [",", "\t", "\x01", "\\", "."]:
        got = [r[0] for r in df.select(tx.split_line("s", sep)).collect()]
        assert got == [t.split(sep) for t in texts], sep


def test_split_line_regex_matches_java_rule(spark):
    texts = random_texts(2)
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for regex in [",", ",|;", "[,;]+"]:
        got = [r[0] for r in df.select(tx.split_line_regex("s", regex)).collect()]
        assert got == [py_split_regex(t, regex) for t in texts], regex


def test_col_filter_matches_python(spark):
    rnd = random.Random(3)
    rows = [[rnd.choice(["", "x", "\\N", "yy"]) for _ in range(rnd.randint(1, 5))] for _ in range(200)]
    df = spark.createDataFrame([(r,) for r in rows], "f array<string>")
    spec = "#3,#0,k,null,#1,#9"
    got = [tuple(r) for r in df.select(*tx.col_filter("f", spec, null_string="\\N")).collect()]

    def pick(fields, i):
        if i >= len(fields):
            return None
        return None if fields[i] == "\\N" else fields[i]

    want = [(pick(f, 3), pick(f, 0), "k", "", pick(f, 1), pick(f, 9)) for f in rows]
    assert got == want


_LONG = [(r"\d{8} \d{2}:[0-5]\d:[0-5]\d", "%Y%m%d %H:%M:%S"),
         (r"\d{4}-\d{2}-\d{2} \d{2}:[0-5]\d:[0-5]\d", "%Y-%m-%d %H:%M:%S")]
_SHORT = [(r"\d{8}", "%Y%m%d"), (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
          (r"\d{2}:[0-5]\d:[0-5]\d", "%H:%M:%S")]


def py_parse_dates(s):
    """The trial-format rule, stated with Python's own parser."""
    if s is None:
        return None
    t = s.strip("".join(chr(i) for i in range(0x21)))
    for shape, fmt in (_LONG if len(s) > 11 else _SHORT):
        if re.fullmatch(shape, t, flags=re.ASCII):
            try:
                v = dt.datetime.strptime(t, fmt)
            except ValueError:
                return None
            return v.replace(year=1970, month=1, day=1) if fmt == "%H:%M:%S" else v
    return None


def test_parse_dates_matches_python(spark):
    rnd = random.Random(4)
    texts = [None]
    for _ in range(600):
        y, m, d = rnd.randint(1900, 2100), rnd.randint(0, 13), rnd.randint(0, 32)
        h, mi, se = rnd.randint(0, 25), rnd.randint(0, 61), rnd.randint(0, 61)
        shape = rnd.randint(0, 5)
        core = [f"{y:04d}{m:02d}{d:02d}", f"{y:04d}-{m:02d}-{d:02d}",
                f"{y:04d}{m:02d}{d:02d} {h:02d}:{mi:02d}:{se:02d}",
                f"{y:04d}-{m:02d}-{d:02d} {h:02d}:{mi:02d}:{se:02d}",
                f"{h:02d}:{mi:02d}:{se:02d}", f"{y}/{m}/{d}"][shape]
        pad = rnd.choice(["", " ", "  ", "\t", " \n"])
        texts.append(pad + core + rnd.choice(["", " ", "\t"]))
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(D.parse_dates("s")).collect()]
    assert got == [py_parse_dates(t) for t in texts]


def test_delimited_round_trip_property(spark, tmp_dir):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        rows.append((i, rnd.choice([None, *random_texts(6 + i, n=1, max_len=8)]),
                     rnd.choice([None, "", "a\nb", "c\rd", "x\ty"])))
    df = spark.createDataFrame(rows, "id int, a string, b string")
    path = sk.write_delimited(df, tmp_dir, prefix="rt", field_split="\t", null_char="")
    back = src.read_delimited(spark, path, field_split="\t", null_string="", num_fields=3)
    got = sorted(tuple(r) for r in back.select(F.col("_c0").cast("int"), "_c1", "_c2").collect())

    def norm(v):
        if v is None:
            return None
        v = v.replace("\t", " ").replace("\r", " ").replace("\n", " ")
        return v or None

    assert got == sorted((i, norm(a), norm(b)) for i, a, b in rows)
