"""The SequenceFile data source: classes, splits, compression, commits."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadbay.sinks import files as sk
from loadbay.sources import files as src
from loadbay.sources import http
from loadbay.sources import sequence as sq

VALUES = {
    "Text": ("string", ["", "a", "é\U0001f600" * 90, "\x00 b"]),
    "BytesWritable": ("binary", [b"", b"x\x00y"]),
    "BooleanWritable": ("boolean", [True, False]),
    "ByteWritable": ("tinyint", [-128, 0, 127]),
    "IntWritable": ("int", [0, -1, 2**31 - 1, -2**31]),
    "LongWritable": ("bigint", [0, -1, 2**63 - 1, -2**63]),
    "VIntWritable": ("int", [0, -112, -113, 127, 128, -129, 2**31 - 1, -2**31]),
    "VLongWritable": ("bigint", [2**63 - 1, -2**63, 300, -300, 2**40]),
    "FloatWritable": ("float", [0.5, -2.25, float("inf")]),
    "DoubleWritable": ("double", [0.1, -2.25, float("-inf")]),
}
#: Classes that Spark's own converters read, for a second opinion.
HADOOP = {"Text", "BooleanWritable", "IntWritable", "LongWritable", "FloatWritable", "DoubleWritable"}


@pytest.mark.parametrize("cls", sorted(VALUES))
def test_classes(spark, tmp_dir, cls):
    kind, values = VALUES[cls]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n bigint, v {kind}")
    path = sk.write_sequence(df, tmp_dir, prefix="s", key_index=0, key_class="Long", value_class=cls)
    back = src.read_pairs(spark, path)
    assert back.dtypes == [("key", "bigint"), ("value", kind)]
    assert [r.value for r in back.orderBy("key").collect()] == values
    as_key = sk.write_sequence(df.select("v"), tmp_dir, prefix="k", key_index=0, key_class=cls,
                               value_class="NullWritable")
    got = src.read_pairs(spark, as_key).collect()
    assert sorted(map(str, (r.key for r in got))) == sorted(map(str, values)) and {r.value for r in got} == {None}
    if cls in HADOOP:
        assert sorted(spark.sparkContext.sequenceFile(path).collect()) == sorted(enumerate(values))


@pytest.mark.parametrize("compression", ["NONE", "RECORD", "BLOCK"])
@pytest.mark.parametrize("codec", ["DefaultCodec", "GzipCodec", "BZip2Codec"])
def test_large_file_is_read_by_several_tasks(spark, tmp_dir, compression, codec):
    rng = random.Random(5)
    rows = [(i, rng.randbytes(rng.choice([0, 3, 200, 3000])).hex()) for i in range(3000)] + [(9000, "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "k bigint, v string").coalesce(1)
    path = sk.write_sequence(df, tmp_dir, prefix="s", key_index=0, key_class="Long", compression=compression,
                             codec=f"org.apache.hadoop.io.compress.{codec}")
    assert len([f for f in os.listdir(path) if f.endswith(".seq")]) == 1
    for split in (40_000, 70_000, 1 << 30) if compression == "BLOCK" else (70_000, 1 << 30):
        back = src.read_pairs(spark, path, split)
        tasks = back.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1 or split == 1 << 30
        assert sorted(map(tuple, back.collect())) == rows
    if codec == "DefaultCodec":
        assert sorted(spark.sparkContext.sequenceFile(path).collect()) == rows


def test_every_split_size_reads_every_record_once(tmp_dir):
    """Ranges of any size, markers across their borders and inside the header."""
    for compression in ("NONE", "BLOCK"):
        path = f"{tmp_dir}/{compression}"
        with open(path, "wb") as fh:
            out = sq._Output(fh, "LongWritable", "Text", compression, "DefaultCodec")
            for i in range(40):
                out.add(sq.encode_column(pa.array([i]), "LongWritable"), sq.encode_column(pa.array(["v" * i]), "Text"))
                out.since = sq.SYNC_EVERY if i % 3 == 0 else 0
                if compression == "BLOCK" and i % 7 == 0:
                    out.flush()
            out.flush()
        size = os.path.getsize(path)
        for split in [1, 2, 3, 19, 20, 21, 50, 97, 128, size - 1, size]:
            got = []
            for start in range(0, size, split):
                file = sq._Input(*sq.file_system(path))
                head = sq.read_header(file)
                got += [int.from_bytes(k, "big") for k, _ in sq.records(file, head, start, min(start + split, size))]
            assert got == list(range(40)), (compression, split)


def test_files_written_by_hadoop(spark, tmp_dir):
    pairs = spark.sparkContext.parallelize([(i, f"v{i}") for i in range(500)], 3)
    pairs.saveAsNewAPIHadoopFile(
        f"{tmp_dir}/h", "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        keyClass="org.apache.hadoop.io.IntWritable", valueClass="org.apache.hadoop.io.Text",
        conf={"mapreduce.output.fileoutputformat.compress": "true",
              "mapreduce.output.fileoutputformat.compress.type": "BLOCK"})
    back = src.read_pairs(spark, f"{tmp_dir}/h")
    assert back.dtypes[0] == ("key", "int") and sorted(map(tuple, back.collect())) == [(i, f"v{i}") for i in range(500)]
    rows = src.read_sequence(spark, f"{tmp_dir}/*/part-*", ignore_key=False, num_fields=2)
    assert rows.count() == 500 and rows.filter("_c1 = concat('v', _c0)").count() == 500


def test_nulls_modes_and_errors(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, "b")], "k bigint, v string")
    path = sk.write_sequence(df, tmp_dir, prefix="s", key_index=0, key_class="Long", null_char="-")
    assert sorted(map(tuple, src.read_pairs(spark, path).collect())) == [(1, "-"), (2, "b")]
    with pytest.raises(FileExistsError):
        sk.write_sequence(df, tmp_dir, prefix="s", del_mode=1)
    sk.write_sequence(df.limit(1), tmp_dir, prefix="s", key_index=0, key_class="Long")
    assert src.read_pairs(spark, path).count() == 1
    with pytest.raises(Exception, match="can't hold NULL"):
        sk.write_sequence(df.select(F.lit(None).cast("int").alias("n")), tmp_dir, prefix="n", value_class="Int")
    with pytest.raises(ValueError):
        sk.write_sequence(df, tmp_dir, prefix="two", value_class="Int")
    with pytest.raises(ValueError):
        sk.write_sequence(df, tmp_dir, prefix="c", codec="NoSuchCodec")
    empty = sk.write_sequence(df.limit(0), tmp_dir, prefix="e", key_index=0)
    assert src.read_sequence(spark, empty, num_fields=1).count() == 0


def test_failed_write_leaves_the_folder_as_it_was(spark, tmp_dir):
    good = spark.createDataFrame([(1, "7")], "k bigint, v string")
    path = sk.write_sequence(good, tmp_dir, prefix="s", key_index=0, key_class="Long", value_class="Int")
    before = sorted(os.listdir(path))
    bad = spark.createDataFrame([(i, None if i == 90 else i) for i in range(100)], "k bigint, v int").repartition(4)
    with pytest.raises(Exception):
        sk.write_sequence(bad, tmp_dir, prefix="s", key_index=0, key_class="Long", value_class="Int")
    assert sorted(os.listdir(path)) == before
    assert [tuple(r) for r in src.read_pairs(spark, path).collect()] == [(1, 7)]


def test_empty_files_are_text(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/d/in ner")
    open(f"{tmp_dir}/d/none", "w").close()
    open(f"{tmp_dir}/d/in ner/no%20ne.gz", "w").close()
    with open(f"{tmp_dir}/d/a b", "w") as fh:
        fh.write("x")
    kinds = {r.path.rsplit("/", 1)[-1]: r.kind for r in src.detect_format(spark, f"{tmp_dir}/d").collect()}
    assert kinds == {"none": "TXT", "no%20ne.gz": "TXT", "a b": "TXT"}
    assert src.list_files(spark, f"{tmp_dir}/d").count() == 1
    assert src.list_files(spark, f"{tmp_dir}/d", with_empty=True).count() == 3
    sk.write_delimited(spark.range(3), tmp_dir, prefix="gz", compression="gzip")
    open(f"{tmp_dir}/gz/none", "w").close()
    assert src.folder_kind(spark, f"{tmp_dir}/gz") == "COMP_TXT"
    assert src.read_detected(spark, f"{tmp_dir}/gz", num_fields=1).count() == 3


def test_default_fetch(spark, tmp_dir):
    with open(f"{tmp_dir}/page", "wb") as fh:
        fh.write("a,中\nb,\n".encode("gbk"))
    rows = http.read_http(spark, f"file://{tmp_dir}/page", charset="gbk", num_fields=2)
    assert [tuple(r)[1:] for r in rows.orderBy("line_no").collect()] == [(0, "a", "中"), (1, "b", None)]
    with pytest.raises(Exception, match="no-such-page"):
        http.read_http(spark, f"file://{tmp_dir}/no-such-page").collect()
