"""File sinks (K1-K6, K15-K18): delimited, compressed and sequence text,
typed Parquet, CSV with a user header, console lines, text plus schema.

A sink's unit is one dataset directory (``dir/prefix``).  Clearing policies
(``del_mode``, ``write_mode``) map to Spark save modes on that directory;
only "clear everything in the parent" deletes through the Hadoop file
system API from the driver (a metadata call, no data passes through it).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadbay.functions import text as tx
from loadbay.sources import sequence

# del_mode numbers of the HDFS writer.
DEL_MODES = {
    0: "overwrite",      # overwrite a file of the same name
    1: "errorifexists",  # error if it exists
    2: "overwrite",      # delete that one file
    3: "overwrite",      # delete prefix-* (the default)
    4: "clear_parent",   # delete everything in the folder
}

# write_mode names of the file / FTP writers.
WRITE_MODES = {"truncate": "overwrite", "append": "append", "nonconflict": "errorifexists"}


def _join(dir_: str, prefix: str | None) -> str:
    return dir_.rstrip("/") + ("/" + prefix if prefix else "")


def hadoop_delete_children(spark: SparkSession, dir_: str) -> None:
    """Delete everything inside ``dir_`` (not ``dir_`` itself) via Hadoop FS."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    path = jvm.org.apache.hadoop.fs.Path(dir_)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return
    for st in fs.listStatus(path):
        fs.delete(st.getPath(), True)


def _save_mode(spark: SparkSession, target: str, parent: str, del_mode: int | None,
               write_mode: str | None) -> str:
    if write_mode is not None:
        key = write_mode.lower()
        if key not in WRITE_MODES:
            raise ValueError(f"unknown write_mode {write_mode!r}")
        return WRITE_MODES[key]
    mode = DEL_MODES.get(3 if del_mode is None else del_mode)
    if mode is None:
        raise ValueError(f"unknown del_mode {del_mode!r}")
    if mode == "clear_parent":
        hadoop_delete_children(spark, parent)
        return "overwrite"
    return mode


def text_lines(df: DataFrame, field_split: str = "\x01", line_split: str = "\n",
               null_char: str = "", sanitize: bool = True) -> DataFrame:
    """Rows -> one ``value`` line each: fields cleaned of separators and line
    ends (P13a), NULL written as ``null_char`` (P15), joined by the separator."""
    cols = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`").cast("string")
        # Numbers, dates and booleans print without separators or line ends:
        # only text columns need cleaning.
        if sanitize and isinstance(f.dataType, (T.StringType, T.BinaryType)):
            col = tx.sanitize_hdfs(col, field_split, line_split)
        cols.append(col)
    return df.select(tx.join_fields(cols, field_split, null_char).alias("value"))


def write_delimited(df: DataFrame, dir_: str, prefix: str | None = None,
                    field_split: str = "\x01", line_split: str = "\n", null_char: str = "",
                    compression: str | None = None, del_mode: int | None = None,
                    write_mode: str | None = None, file_count: int | None = None,
                    encoding: str | None = None,
                    number_files: bool = False) -> str:
    """K1/K2/K5/K6: delimited text (optionally compressed) into ``dir/prefix``.

    ``compression``: ``gzip``, ``bzip2``, ``deflate`` ... (``"default"`` =
    deflate).  ``file_count`` repartitions to that many files (never
    ``coalesce(1)`` by default); ``number_files`` names them ``prefix-i``.
    ``encoding`` other than UTF-8 writes the encoded bytes
    (P18).  Returns the dataset path.
    """
    spark = df.sparkSession
    target = _join(dir_, prefix)
    mode = _save_mode(spark, target, dir_, del_mode, write_mode)
    lines = text_lines(df, field_split, line_split, null_char)
    if encoding and encoding.lower().replace("-", "") != "utf8":
        from loadbay.sources.files import enable_java_charsets

        enable_java_charsets(spark)
        # The text sink writes a string's bytes as they are, so the encoded
        # bytes travel in a string column that is never read as UTF-8.
        lines = lines.select(tx.encode_text("value", encoding).cast("string").alias("value"))
    if file_count:
        lines = lines.repartition(file_count)
    writer = lines.write.mode(mode).option("lineSep", line_split)
    if compression:
        writer = writer.option("compression", "deflate" if compression == "default" else compression)
    writer.text(target)
    if number_files:
        number_part_files(spark, target, prefix or target.rstrip("/").rsplit("/", 1)[-1])
    return target


# SequenceFile compression kinds.
SEQ_COMPRESSION = ("NONE", "RECORD", "BLOCK")


def write_sequence(df: DataFrame, dir_: str, prefix: str | None = None, key_index: int = -1,
                   field_split: str = "\x01", null_char: str = "",
                   compression: str = "NONE", codec: str = "org.apache.hadoop.io.compress.DefaultCodec",
                   del_mode: int | None = None, key_class: str | None = None,
                   value_class: str = "Text") -> str:
    """K3: SequenceFile of a key and a value of any Writable class.

    ``key_index >= 0`` takes that field as key (``key_class``, Text by default)
    and removes it from the value; otherwise the key is empty (NullWritable).
    A Text value is the remaining fields joined by the separator; any other
    ``value_class`` needs exactly one remaining field, which is cast to it (none
    for NullWritable).  NULL is ``null_char`` in a Text, empty in a BytesWritable
    and an error in the other classes.  ``compression`` is NONE, RECORD or BLOCK;
    ``codec`` one of Default, Deflate, Gzip and BZip2.
    """
    spark = df.sparkSession
    target = _join(dir_, prefix)
    mode = _save_mode(spark, target, dir_, del_mode, None)
    if compression.upper() not in SEQ_COMPRESSION:
        raise ValueError(f"unknown compression {compression!r}")
    sequence.codec_of(codec)
    names = [F.col(f"`{c}`") for c in df.columns]
    has_key = 0 <= key_index < len(names)
    key_name = sequence.class_name(key_class or "Text") if has_key else "NullWritable"
    value_name = sequence.class_name(value_class)
    rest = names[:key_index] + names[key_index + 1:] if has_key else names
    if value_name not in ("Text", "NullWritable") and len(rest) != 1:
        raise ValueError(f"{value_name} takes one field, {len(rest)} are left")

    def typed(col: Column | None, name: str) -> Column:
        if col is None or name == "NullWritable":
            return F.lit(None).cast("string")
        col = col.cast(sequence.CLASSES[name][0])
        return tx.null_out(col, null_char) if name == "Text" else col

    if value_name == "Text":
        value = tx.join_fields([tx.sanitize_hdfs(c.cast("string"), field_split) for c in rest],
                               field_split, null_char)
    else:
        value = typed(rest[0] if rest else None, value_name)
    pairs = df.select(typed(names[key_index] if has_key else None, key_name).alias("key"), value.alias("value"))
    if mode == "errorifexists" and hadoop_exists(spark, target):
        raise FileExistsError(target)
    sequence.register(spark)
    (pairs.write.format("sequence").mode("append" if mode == "errorifexists" else mode)
     .options(keyClass=key_name, valueClass=value_name, compression=compression, codec=codec).save(target))
    return target


def hadoop_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


def number_part_files(spark: SparkSession, target: str, prefix: str) -> list[str]:
    """K6 naming: the data files of a written folder become ``prefix`` (one
    file) or ``prefix-0 .. prefix-(n-1)`` (several), suffixes kept.  Renames
    are metadata calls on the driver, one per file."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    root = jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(conf)
    parts = sorted(st.getPath().getName() for st in fs.listStatus(root)
                   if st.isFile() and st.getPath().getName().startswith("part-"))
    names = []
    for i, name in enumerate(parts):
        dot = name.find(".")
        suffix = name[dot:] if dot >= 0 else ""
        new = f"{prefix}{suffix}" if len(parts) == 1 else f"{prefix}-{i}{suffix}"
        fs.rename(jvm.org.apache.hadoop.fs.Path(root, name), jvm.org.apache.hadoop.fs.Path(root, new))
        names.append(new)
    return names


def parquet_column_name(name: str) -> str:
    """Target column names are cut after the first ``.`` (``t.col`` -> ``t``)."""
    return name.split(".", 1)[0]


def write_parquet_typed(df: DataFrame, dir_: str, types: dict[str, str] | Sequence[str] | None = None,
                        prefix: str | None = None, del_mode: int | None = None,
                        compression: str = "snappy",
                        parquet_schema: T.StructType | str | None = None) -> str:
    """K4: text columns typed by Hive type names (P17), written as Parquet.

    Decimal/number -> double, small integers -> int, bigint -> long, unknown
    -> text; empty or bad text -> NULL; all columns nullable.  An explicit
    ``parquet_schema`` (StructType or DDL) names and types the columns by
    position instead.
    """
    spark = df.sparkSession
    target = _join(dir_, prefix)
    mode = _save_mode(spark, target, dir_, del_mode, None)
    if parquet_schema is not None:
        schema = (parquet_schema if isinstance(parquet_schema, T.StructType)
                  else T._parse_datatype_string(parquet_schema))
        typed = df.select([F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).try_cast(f.dataType).alias(f.name)
                           for c, f in zip(df.columns, schema.fields)])
    else:
        typed = tx.typed_by_hive(df, types)
        typed = typed.select([F.col(f"`{c}`").alias(parquet_column_name(c)) for c in typed.columns])
    typed.write.mode(mode).option("compression", compression).parquet(target)
    return target


# --------------------------------------------------------------------------
# Console lines
# --------------------------------------------------------------------------

def format_rows(df: DataFrame, field_split: str = "\t", prefix: str = "",
                null_char: str = "") -> DataFrame:
    """K15 body: each row as one line ``prefix + fields joined``; NULL fields
    print as ``null_char``; a row without fields prints the prefix alone."""
    cols = [F.col(f"`{c}`").cast("string") for c in df.columns]
    if not cols:
        return df.select(F.lit(prefix).alias("line"))
    return df.select(tx.join_fields(cols, field_split, null_char, prefix=prefix).alias("line"))


def print_rows(df: DataFrame, field_split: str = "\t", prefix: str = "", null_char: str = "",
               print_: bool = True) -> int:
    """Print every row on the executors' standard output (each task its
    own rows, in Arrow batches); ``print_=False`` runs the job into the
    ``noop`` sink.  Returns
    the number of rows, counted by an observation of the same job."""
    from pyspark.sql import Observation

    lines = format_rows(df, field_split, prefix, null_char)
    obs = Observation("print_rows")
    observed = lines.observe(obs, F.count(F.lit(1)).alias("rows"))
    if not print_:
        observed.write.format("noop").mode("overwrite").save()
    else:
        def emit(batches):
            import sys

            for pdf in batches:
                if len(pdf):
                    sys.stdout.write("\n".join(pdf["line"]) + "\n")
                    sys.stdout.flush()
                yield pdf.iloc[0:0]

        # Arrow batches of lines are written by each task, a batch at a time.
        observed.mapInPandas(emit, "line string").write.format("noop").mode("overwrite").save()
    return int(obs.get["rows"])


# --------------------------------------------------------------------------
# CSV or text files with a user header, prefix write modes
# --------------------------------------------------------------------------

def write_files(df: DataFrame, path: str, prefix: str | None = None, file_format: str = "csv",
                header: Sequence[str] | None = None, field_split: str = "\t",
                write_mode: str = "truncate", null_char: str = "", encoding: str = "utf-8",
                skip_empty_rows: bool = True, must_contain: str | None = None,
                compression: str | None = None, trim: bool = False, empty_text: str = "") -> str:
    """CSV (quoted) or plain text files on any Hadoop URI.

    ``header`` is the user's list of names written as the first line of every
    non-empty part file.  Rows whose fields are all NULL are skipped.
    ``write_mode``: truncate / append / nonConflict.  ``must_contain`` is an
    optional guard on the target path.

    CSV keeps the blanks around a field unless ``trim``.  An empty text is
    written as ``empty_text``: nothing by default, as a NULL is; ``'""'`` tells
    the two apart, also for Spark's CSV reader if its ``nullValue`` is not empty.
    """
    if must_contain and must_contain not in path:
        raise ValueError(f"target path must contain {must_contain!r}")
    spark = df.sparkSession
    target = _join(path, prefix)
    mode = _save_mode(spark, target, path, None, write_mode)
    out = df
    if skip_empty_rows and df.columns:
        any_field = None
        for c in df.columns:
            term = F.col(f"`{c}`").isNotNull()
            any_field = term if any_field is None else (any_field | term)
        out = out.filter(any_field)
    if file_format.lower() == "csv":
        names = list(header) if header else out.columns
        if len(names) != len(out.columns):
            raise ValueError("header does not match the number of columns")
        out = out.select([F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(out.columns, names)])
        w = (out.write.mode(mode).option("header", "true" if header else "false")
             .option("sep", field_split).option("quote", '"').option("escape", '"')
             .option("nullValue", null_char).option("emptyValue", empty_text)
             .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
             .option("encoding", encoding))
        if compression:
            w = w.option("compression", compression)
        w.csv(target)
        return target
    lines = text_lines(out, field_split, "\n", null_char, sanitize=False)
    if header:
        # Each non-empty part file starts with the header line: a one-column
        # CSV whose column name is that line.  Quoting is kept out of the way
        # (a separator no line holds, quote/escape never triggered) and
        # blanks are kept, so every line is written exactly as it is.
        lines = lines.withColumnRenamed("value", field_split.join(header))
        (lines.write.mode(mode).option("header", "true")
         .option("sep", _NEVER_SEP).option("quote", "\u0002").option("escape", "\u0002")
         .option("escapeQuotes", "false").option("quoteAll", "false")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .option("emptyValue", "").option("encoding", encoding)
         .options(**({"compression": compression} if compression else {})).csv(target))
        return target
    if encoding.lower().replace("-", "") != "utf8":
        lines = lines.select(tx.encode_text("value", encoding).cast("string").alias("value"))
    lines.write.mode(mode).options(**({"compression": compression} if compression else {})).text(target)
    return target


# --------------------------------------------------------------------------
# Text plus schema sidecar
# --------------------------------------------------------------------------

SCHEMA_FILE = "__metadata"

# A multi-character separator for one-column CSV output: never inside a line.
_NEVER_SEP = "\u0000\u0000\u0001\u0000"


def write_with_schema(df: DataFrame, path: str, field_split: str = "\x01",
                      null_char: str = "\\N", mode: str = "overwrite") -> str:
    """All-text dataset plus its schema (names lower-cased) as a
    ``__metadata`` sidecar; Spark readers skip names starting with ``_``."""
    spark = df.sparkSession
    lowered = df.toDF(*[c.lower() for c in df.columns])
    schema_json = lowered.schema.json()
    lines = text_lines(lowered, field_split, "\n", null_char)
    lines.write.mode(mode).text(path)
    spark.createDataFrame([(schema_json,)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path.rstrip("/") + "/" + SCHEMA_FILE)
    return path


def read_with_schema(spark: SparkSession, path: str, field_split: str = "\x01",
                     null_string: str = "\\N") -> DataFrame:
    """Read the text back and restore names and types from the sidecar."""
    from loadbay.sources.files import read_delimited

    meta = spark.read.text(path.rstrip("/") + "/" + SCHEMA_FILE).first()[0]
    schema = T.StructType.fromJson(json.loads(meta))
    rows = read_delimited(spark, path, field_split=field_split, null_string=null_string,
                          num_fields=len(schema.fields))
    cols = []
    for i, f in enumerate(schema.fields):
        c = F.col(f"_c{i}")
        if not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return rows.select(cols)

