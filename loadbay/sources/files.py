"""File sources (R1-R7, R16): delimited, compressed and sequence text,
Parquet as text, format detection, path expansion and partition folders.

Every reader stays lazy and returns a DataFrame; file splits are Spark's own
(a gzip file is one task: call ``repartition`` after the read when the next
step is heavy).  Columns are text: ``_c0 .. _cN`` when the arity is known,
else one ``fields`` array column.
"""

from __future__ import annotations

import re

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadbay.functions import text as tx
from loadbay.sources import sequence

# File suffixes read as compressed text.
COMPRESSED_SUFFIXES = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def lines_to_rows(lines: DataFrame, field_split: str = "\t", null_string: str | None = "",
                  col_filter: str | None = None, num_fields: int | None = None,
                  keep_last: bool = False, value_col: str = "value",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Shared tail of every text reader: split, NULL-map, pick fields.

    ``num_fields`` fixes the arity (``_c0..``); ``col_filter`` picks fields
    (its length is the arity); with neither, one ``fields`` array column.
    ``keep`` passes extra columns (file name, partition values) through.
    """
    # The fields are split once into a column, then picked from it.
    lines = lines.select(tx.split_line(F.col(value_col), field_split).alias("_fields"),
                         *[F.col(k) for k in keep])
    arr = F.col("_fields")
    extra = [F.col(k) for k in keep]
    if col_filter:
        # Constants are not NULL-mapped; picked fields are (unless keep_last
        # says the last field of the line is exempt).
        if keep_last:
            arr = tx.null_map_fields(arr, null_string, keep_last=True)
            cols = tx.col_filter(arr, col_filter, None)
        else:
            cols = tx.col_filter(arr, col_filter, null_string)
        return lines.select(*cols, *extra)
    mapped = tx.null_map_fields(arr, null_string, keep_last=keep_last)
    if num_fields is None:
        return lines.select(mapped.alias("fields"), *extra)
    return lines.select(*tx.fields_to_columns(mapped, num_fields), *extra)


def read_delimited(spark: SparkSession, path: str | Sequence[str], field_split: str = "\t",
                   null_string: str | None = "", col_filter: str | None = None,
                   num_fields: int | None = None, encoding: str = "utf-8",
                   line_sep: str | None = None, with_file: bool = False,
                   repartition: int | None = None) -> DataFrame:
    """Delimited (optionally compressed) text -> text columns.

    The separator is one literal character, every empty field is kept and
    there is no quoting (this is *not* the CSV reader).  Lines end at
    ``\\n``, ``\\r`` or ``\\r\\n``.  ``null_string`` (default ``""``) maps every
    field, the last one included.  Compression follows the file suffix.
    ``encoding`` other than UTF-8 decodes each line first (P18).
    ``repartition`` spreads the lines before splitting (a gzip or bzip2 file
    is read by one task).
    """
    keep = ["_file"] if with_file else []
    if encoding.lower().replace("-", "") != "utf8":
        enable_java_charsets(spark)
        lines = read_text_bytes(spark, path, charset=encoding, line_sep=line_sep,
                                with_file=with_file)
    else:
        reader = spark.read.format("text")
        if line_sep is not None:
            reader = reader.option("lineSep", line_sep)
        lines = reader.load(_paths(path))
        if with_file:
            lines = lines.withColumn("_file", F.col("_metadata.file_path"))
    if repartition:
        lines = lines.repartition(repartition)
    return lines_to_rows(lines, field_split, null_string, col_filter, num_fields, keep=keep)


def enable_java_charsets(spark: SparkSession) -> None:
    """GBK, GB2312 and other JVM charsets in ``encode``/``decode`` need the
    session flag ``spark.sql.legacy.javaCharsets``; characters a charset
    cannot encode become ``?`` (the JVM's replacement, as the loaders wrote
    them) with ``spark.sql.legacy.codingErrorAction``.  Both are turned on."""
    for key in ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"):
        if spark.conf.get(key, "false").lower() != "true":
            spark.conf.set(key, "true")


def read_text_bytes(spark: SparkSession, path: str | Sequence[str], charset: str,
                    line_sep: str | None = None, with_file: bool = False) -> DataFrame:
    """Text lines in a non-UTF-8 charset -> ``value`` decoded.

    Lines are cut on raw bytes (safe for GBK: its trail bytes never equal a
    line end) and decoded before any field split.  GBK/GB2312 need
    ``spark.sql.legacy.javaCharsets=true``.
    """
    reader = spark.read.format("text")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    raw = reader.load(_paths(path))
    # The text source does not validate UTF-8: casting the line back to
    # binary gives the file's own bytes, which are then decoded.
    cols = [tx.decode_text(F.col("value"), charset).alias("value")]
    if with_file:
        cols.append(F.col("_metadata.file_path").alias("_file"))
    return raw.select(cols)


def read_pairs(spark: SparkSession, path: str, split_bytes: int = sequence.SPLIT_BYTES) -> DataFrame:
    """SequenceFiles as ``key`` and ``value`` of their Writable classes' types."""
    sequence.register(spark)
    return spark.read.format("sequence").option("splitBytes", split_bytes).load(path)


def read_sequence(spark: SparkSession, path: str, field_split: str = "\x01",
                  null_string: str | None = "", ignore_key: bool = True,
                  col_filter: str | None = None, num_fields: int | None = None) -> DataFrame:
    """SequenceFile of (key, value) -> rows.

    The value text is split like R1.  The key is the first field unless
    ``ignore_key`` (the default) or the key is a NullWritable.  A
    NullWritable value contributes no fields.

    Keys and values of any Writable class are read through the data source
    ``sequence`` (splits at sync markers) and become text; NullWritable is NULL.
    Globs are expanded by Spark's listing; files without bytes hold no rows.
    """
    if any(ch in path for ch in "*?[{"):
        found = list_files(spark, path).filter("length > 0").select("path").collect()
        path = ",".join(sorted(r.path for r in found))
    df = read_pairs(spark, path).select(F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"))
    # A NullWritable arrives as NULL: a NULL value gives no fields, a NULL
    # key is skipped; an empty Text is one empty field like any other text.
    value_fields = F.when(F.col("v").isNull(), F.array().cast("array<string>")).otherwise(
        tx.split_line(F.col("v"), field_split))
    if ignore_key:
        arr = value_fields
    else:
        arr = F.when(F.col("k").isNull(), value_fields).otherwise(
            F.concat(F.array(F.col("k")), value_fields))
    lines = df.select(arr.alias("arr"))
    if col_filter:
        return lines.select(*tx.col_filter(F.col("arr"), col_filter, null_string))
    mapped = tx.null_map_fields(F.col("arr"), null_string)
    if num_fields is None:
        return lines.select(mapped.alias("fields"))
    return lines.select(*tx.fields_to_columns(mapped, num_fields))


def read_parquet_as_text(spark: SparkSession, path: str | Sequence[str],
                         null_string: str | None = "", columns: Sequence[str] | None = None,
                         col_filter: str | None = None) -> DataFrame:
    """Parquet -> every column as text, schema order kept.

    Repeated fields give their last element; ``null_string`` maps text to
    NULL.  ``columns`` prunes at the scan; ``col_filter`` (positions of the
    file schema) is applied too.
    """
    df = spark.read.parquet(*_paths(path))
    if columns:
        df = df.select([F.col(f"`{c}`") for c in columns])
    text = tx.to_text_rows(df, null_string)
    if not col_filter:
        return text
    arr = F.array(*[F.col(f"`{c}`") for c in text.columns])
    return text.select(*tx.col_filter(arr, col_filter, None))


# --------------------------------------------------------------------------
# Listing and classifying files
# --------------------------------------------------------------------------

def list_files(spark: SparkSession, root: str | Sequence[str], pattern: str | None = None,
               recursive: bool = True, with_empty: bool = False) -> DataFrame:
    """All files below ``root`` (glob allowed in the path, ``pattern`` on
    the file name) as ``(path, length, modificationTime)``; no content read.

    A scan has no rows for files without bytes.  ``with_empty`` adds them, from
    the names that Spark's listing keeps on the driver anyway; their time is NULL."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    scan = reader.load(_paths(root))
    files = scan.select("path", "length", "modificationTime")
    if not with_empty:
        return files
    # Names come escaped and with an empty authority, the scan's paths without.
    names = spark.createDataFrame([(re.sub("^([^:/]+):///", r"\1:/", unquote(p)),) for p in scan.inputFiles()],
                                  "path string")
    empty = names.join(files.select("path"), "path", "left_anti")
    return files.unionByName(empty.select("path", F.lit(0).cast("bigint").alias("length"),
                                          F.lit(None).cast("timestamp").alias("modificationTime")))


def expand_paths(spark: SparkSession, root: str, max_depth: int | None = None,
                 pattern: str | None = None, on_too_deep: str = "error") -> DataFrame:
    """Files below ``root`` with their depth (1 = directly in ``root``).

    ``root`` may hold globs.  ``max_depth`` limits the walk: a deeper file is
    an error unless ``on_too_deep="skip"`` asks for it to be left out.
    """
    root_uri = root.rstrip("/")
    files = list_files(spark, root_uri, pattern)
    # The listing gives fully qualified URIs; depth counts the folders after
    # the root component.
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _root_tail(root_uri) + "/", "")
    files = files.withColumn("depth", F.size(F.split(rel, "/")))
    if max_depth is None:
        return files
    if on_too_deep == "error":
        too_deep = files.filter(F.col("depth") > max_depth).limit(1).count()
        if too_deep:
            raise ValueError(f"files below {root} deeper than {max_depth} levels")
    return files.filter(F.col("depth") <= max_depth)


# The remote listing's default depth limit.
REMOTE_MAX_DEPTH = 10


def list_remote(spark: SparkSession, path: str, max_depth: int = REMOTE_MAX_DEPTH) -> DataFrame:
    """R6 for FTP/SFTP-style sources: a wildcard may appear in the last path
    component only (it filters file names); the walk below the folder is
    limited to ``max_depth`` levels and a deeper file is an error."""
    head, _, last = path.rstrip("/").rpartition("/")
    if any(ch in head for ch in "*?["):
        raise ValueError("a wildcard is only allowed in the last path component")
    if any(ch in last for ch in "*?["):
        return expand_paths(spark, head, max_depth=max_depth, pattern=last, on_too_deep="error")
    return expand_paths(spark, path, max_depth=max_depth, on_too_deep="error")


def _root_tail(root: str) -> str:
    """Pattern of the root's path in a listed URI; globs match inside one name."""
    out, braces = "", 0
    for ch in root.split("://", 1)[-1]:
        braces += (ch == "{") - (ch == "}")
        out += {"*": "[^/]*", "?": "[^/]", "[": "[", "]": "]", "{": "(?:", "}": ")"}.get(
            ch, "|" if ch == "," and braces else re.escape(ch))
    return out


def detect_format(spark: SparkSession, root: str | Sequence[str], with_length: bool = False) -> DataFrame:
    """Classify each file as TXT, COMP_TXT, SEQ or PARQUET.

    Order: ``.parquet`` suffix -> PARQUET; empty file -> TXT; starts with
    ``SEQ`` -> SEQ; starts with ``PA`` -> PARQUET; compression suffix ->
    COMP_TXT; else TXT.  Only the first bytes of each file are read, by the
    executors (``mapInPandas`` over the listing), never whole files.
    """
    files = list_files(spark, root, with_empty=True).select("path", "length")

    def head_bytes(batches):
        import pandas as pd

        for pdf in batches:
            heads = []
            for p, length in zip(pdf["path"], pdf["length"]):
                if length == 0:
                    heads.append(b"")
                    continue
                fs, inner = sequence.file_system(p)
                with fs.open_input_stream(inner, compression=None) as fh:
                    heads.append(fh.read(4))
            yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "head": heads})

    heads = files.mapInPandas(head_bytes, "path string, length bigint, head binary")
    name = F.lower(F.col("path"))
    comp = F.lit(False)
    for suf in COMPRESSED_SUFFIXES:
        comp = comp | name.endswith(suf)
    head = F.col("head")
    kind = (F.when(name.endswith(".parquet"), "PARQUET")
             .when(F.col("length") == 0, "TXT")
             .when(F.substring(head, 1, 3) == F.lit(bytearray(b"SEQ")), "SEQ")
             .when(F.substring(head, 1, 2) == F.lit(bytearray(b"PA")), "PARQUET")
             .when(comp, "COMP_TXT")
             .otherwise("TXT"))
    return heads.select("path", kind.alias("kind"), *(["length"] if with_length else []))


def folder_kind(spark: SparkSession, path: str) -> str:
    """The one kind (R5) of the data files in ``path``; a folder mixing
    kinds is an error.  Files without bytes are TXT but hold no rows: they
    decide only in a folder that has no others.  Only the distinct kinds (at most four values) reach
    the driver."""
    kinds = _kinds(spark, path)
    if len(kinds) != 1:
        raise ValueError(f"{path} holds files of kinds {kinds}")
    return kinds[0]


def _data_files(spark: SparkSession, path: str) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return detect_format(spark, path, with_length=True).filter(~name.startswith("_") & ~name.startswith("."))


def _kinds(spark: SparkSession, path: str) -> list[str]:
    found = _data_files(spark, path).select("kind", (F.col("length") > 0).alias("full")).distinct().collect()
    return sorted({r.kind for r in found if r.full} or {r.kind for r in found})


def read_detected(spark: SparkSession, path: str, field_split: str = "\x01",
                  null_string: str | None = "", num_fields: int | None = None) -> DataFrame:
    """R5 driving the read: the folder's files are read with the reader of
    their kind (text, compressed text, SequenceFile with its key, Parquet as
    text).  A folder of several kinds needs ``num_fields``; every file is read
    by its own kind (the file names of such a folder are listed on the driver,
    as Spark's own listing is) and the rows are united by position."""
    def one(kind: str, paths: list[str]) -> DataFrame:
        if kind == "PARQUET":
            return read_parquet_as_text(spark, paths, null_string=null_string)
        if kind == "SEQ":
            return read_sequence(spark, ",".join(paths), field_split=field_split, null_string=null_string,
                                 ignore_key=False, num_fields=num_fields)
        return read_delimited(spark, paths, field_split=field_split, null_string=null_string,
                              num_fields=num_fields)

    kinds = {"TXT" if k == "COMP_TXT" else k for k in _kinds(spark, path)}
    if len(kinds) == 1:
        return one(kinds.pop(), [path])
    if num_fields is None:
        raise ValueError(f"{path} holds files of kinds {sorted(kinds)}: num_fields is needed")
    by_kind: dict[str, list[str]] = {}
    for file, kind in _data_files(spark, path).filter("length > 0").select("path", "kind").collect():
        by_kind.setdefault("TXT" if kind == "COMP_TXT" else kind, []).append(file)
    out = None
    for kind in sorted(by_kind):
        rows = one(kind, by_kind[kind])
        rows = rows.toDF(*[f"_c{i}" for i in range(num_fields)])
        out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------------------------------------
# Partition folders
# --------------------------------------------------------------------------

def partition_path(root: str, names: Sequence[str], values: Sequence[str]) -> str:
    """``root/pt=20160101/hour=01``; names and values must pair up."""
    if len(names) != len(values):
        raise ValueError("partition names and values do not pair up")
    return "/".join([root.rstrip("/")] + [f"{n}={v}" for n, v in zip(names, values)])


def _partition_folders(spark: SparkSession, root: str, names: Sequence[str],
                       values: Sequence[str | None] | None) -> str | None:
    """The folder, or a glob of the folders, that hold the wanted values; None
    if there are none.  Values after the last wanted one need no glob."""
    wanted = list(values or ())
    while wanted and wanted[-1] is None:
        wanted.pop()
    if not wanted:
        return root
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName  # noqa: SLF001
    parts = [f"{n}={'*' if v is None else escape(str(v))}" for n, v in zip(names, wanted)]
    folder = "/".join([root.rstrip("/"), *parts])
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)  # noqa: SLF001
    return folder if found is not None and len(found) else None


def read_partition(spark: SparkSession, root: str, names: Sequence[str],
                   values: Sequence[str | None] | None = None, field_split: str = "\t",
                   null_string: str | None = "", num_fields: int | None = None,
                   col_filter: str | None = None, fmt: str = "text",
                   drop_partition_columns: bool = False) -> DataFrame:
    """Text below ``name=value`` folders, partition values as text columns.

    Only the folders of ``values`` (``None`` entries = any) are listed.
    Partition values are never type-inferred (the schema declares them as
    text).
    """
    if values is not None and len(values) != len(names):
        raise ValueError("partition names and values do not pair up")
    if fmt == "text":
        schema = T.StructType([T.StructField("value", T.StringType())] +
                              [T.StructField(n, T.StringType()) for n in names])
        folder = _partition_folders(spark, root, names, values)
        if folder is None:
            lines = spark.createDataFrame([], schema)
        else:
            lines = spark.read.schema(schema).option("basePath", root).format("text").load(folder)
    else:
        lines = spark.read.option("basePath", root).format(fmt).load(root)
        for n, v in zip(names, values or ()):
            if v is not None:
                lines = lines.filter(F.col(n) == F.lit(str(v)))
    if fmt != "text":
        return lines.drop(*names) if drop_partition_columns else lines
    keep = [] if drop_partition_columns else list(names)
    return lines_to_rows(lines, field_split, null_string, col_filter, num_fields, keep=keep)


# --------------------------------------------------------------------------
# Remote text (FTP/SFTP or any Hadoop file system), header per file
# --------------------------------------------------------------------------

def read_remote_text(spark: SparkSession, path: str | Sequence[str], field_split: str = "\x01",
                     null_string: str | None = "\\N", skip_header: bool = False,
                     num_fields: int | None = None, col_filter: str | None = None,
                     legacy_last_field: bool = False) -> DataFrame:
    """Text files on any Hadoop file system (``ftp://``, ``sftp://``,
    ``file://`` ...), defaults ``\\001`` and ``\\N``.

    ``skip_header`` drops the first line of *each file* (not of the data
    set): the line whose byte offset in its file is 0.  ``legacy_last_field``
    keeps the last field of a line out of NULL mapping, as the FTP reader did.
    """
    if skip_header:
        lines = _drop_first_line_per_file(spark, path)
    else:
        lines = spark.read.format("text").load(_paths(path))
    return lines_to_rows(lines, field_split, null_string, col_filter, num_fields,
                         keep_last=legacy_last_field)


def _drop_first_line_per_file(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of every file except each file's first line.

    A partition holds whole splits; a split's rows are contiguous, and the
    first line of a file is the first row of the split that starts at byte 0.
    Each task drops it from its own Arrow batches, so nothing is sorted,
    numbered or shuffled; only lines and two numbers (file and start of the
    split) pass through Python.  Empty lines are kept (the CSV reader would
    drop them).
    """
    lines = (spark.read.format("text").load(_paths(path))
             .select("value", F.xxhash64("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start")))

    def drop_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # file and start of the row before
        for batch in batches:
            if batch.num_rows == 0:
                continue
            file, start = (batch.column(c).to_numpy() for c in (1, 2))
            new = np.ones(len(file), bool)
            new[1:] = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
            new[0] = before != (file[0], start[0])
            before = (file[-1], start[-1])
            yield batch.select([0]).filter(pa.array(~(new & (start == 0))))

    return lines.mapInArrow(drop_heads, "value string")
