"""Registered plans over the driver's tables: file round trips and row rules.

Each plan takes ``(spark, sf_dir)``, runs the exchange it names over the
whole tables (writes happen inside the call, into a fresh scratch folder
below ``spark.checkpoint.dir``) and returns a lazy DataFrame whose columns
are aliased exactly like the DuckDB oracle in ``loadbay.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.functions import dates as dt
from loadbay.functions import text as tx
from loadbay.plans.common import scratch, table
from loadbay.sinks import files as sinks
from loadbay.sinks.shared import write_shared
from loadbay.sources import files as sources

# Lineitem as a load job declares it (Hive type names).
LINEITEM_TYPES = ["bigint", "bigint", "bigint", "int", "decimal(15,2)", "decimal(15,2)",
                  "decimal(15,2)", "decimal(15,2)", "string", "string", "string"]


def flagship_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem Parquet -> MySQL-style text -> ``\\001`` files -> read back,
    pick fields, type by Hive names -> per flag/status totals."""
    li = table(spark, sf_dir, "lineitem")
    text = dt.format_dates(li, "mysql")
    path = sinks.write_delimited(text, scratch(spark, "flagship"), field_split="\x01")
    rows = sources.read_delimited(spark, path, field_split="\x01", null_string="",
                                  col_filter="#8,#9,#4,#5,#6,#7")
    typed = tx.typed_by_hive(rows, ["string", "string", "double", "double", "double", "double"])
    return (typed.groupBy(F.col("_c0").alias("l_returnflag"), F.col("_c1").alias("l_linestatus"))
            .agg(F.count(F.lit(1)).alias("count_order"),
                 F.round(F.sum("_c2"), 2).alias("sum_qty"),
                 F.round(F.sum("_c3"), 2).alias("sum_base_price"),
                 F.round(F.sum("_c4"), 2).alias("sum_discount"),
                 F.round(F.sum("_c5"), 2).alias("sum_tax")))


def _typed_back(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cast text columns back (``try_cast``) so numbers compare as numbers."""
    return df.select([F.col(c).try_cast(spec[c]).alias(c) if c in spec else F.col(c)
                      for c in df.columns])


def delimited_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> tab text (separators and line ends
    cleaned, NULL as "") -> read back ("" -> NULL)."""
    docs = table(spark, sf_dir, "documents")
    path = sinks.write_delimited(docs, scratch(spark, "delim"), field_split="\t", null_char="")
    return sources.read_delimited(spark, path, field_split="\t", null_string="", num_fields=5)


def compressed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2/K2/P10: orders as MySQL text, gzip files, read back and typed."""
    orders = table(spark, sf_dir, "orders")
    text = dt.dates_to_text(orders, "mysql")
    path = sinks.write_delimited(text, scratch(spark, "gzip"), field_split="\x01",
                                 compression="gzip")
    rows = sources.read_delimited(spark, path, field_split="\x01", num_fields=6)
    rows = rows.toDF(*orders.columns)
    return _typed_back(rows, {"o_orderkey": "bigint", "o_custkey": "bigint",
                              "o_totalprice": "double"})


def sequence_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer as SequenceFile (key = custkey), read back with the key."""
    cust = table(spark, sf_dir, "customer")
    path = sinks.write_sequence(cust, scratch(spark, "seq"), key_index=0, field_split="\x01")
    rows = sources.read_sequence(spark, path, field_split="\x01", ignore_key=False, num_fields=5)
    return _typed_back(rows, {"_c3": "double"})


def sequence_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as block-compressed SequenceFiles, LongWritable key and the
    other fields as Text, read back as typed pairs."""
    orders = table(spark, sf_dir, "orders")
    path = sinks.write_sequence(dt.dates_to_text(orders, "mysql"), scratch(spark, "seq-typed"), key_index=0,
                                compression="BLOCK", key_class="LongWritable")
    pairs = sources.read_pairs(spark, path)
    fields = tx.fields_to_columns(tx.split_line("value", "\x01"), len(orders.columns) - 1)
    rows = pairs.select("key", *fields).toDF(*orders.columns)
    return _typed_back(rows, {"o_custkey": "bigint", "o_totalprice": "double"})


def parquet_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as all-text columns ("" -> NULL)."""
    text = sources.read_parquet_as_text(spark, f"{sf_dir}/events.parquet", null_string="")
    return _typed_back(text, {"value": "double"})


def parquet_as_text_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeated field reads as its last element."""
    text = sources.read_parquet_as_text(spark, f"{sf_dir}/embeddings.parquet",
                                        columns=["vec_id", "embedding"])
    return text.select("vec_id", F.col("embedding").try_cast("float").cast("double")
                       .alias("embedding_last"))


def col_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events text, fields picked and reordered, constants added."""
    events = dt.dates_to_text(table(spark, sf_dir, "events"), "mysql")
    path = sinks.write_delimited(events, scratch(spark, "colfilter"), field_split="\x01")
    return sources.read_delimited(spark, path, field_split="\x01", null_string="",
                                  col_filter="#5,#2,const,null,#9")


def split_regex_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bodies -> lines -> regex fields, trailing empties dropped."""
    from loadbay.sources.http import parse_bodies

    pages = table(spark, sf_dir, "pages").select(F.col("url"), F.col("html").alias("body"))
    rows = parse_bodies(pages, field_split="<br>|</?p>", null_string="")
    return rows.select("url", "line_no", F.size("fields").alias("n_fields"),
                       F.get("fields", 0).alias("first_field"),
                       F.try_element_at("fields", F.lit(-1)).alias("last_field"))


def null_fit_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names split on blanks, fitted to 3 fields, "ring" -> NULL."""
    part = table(spark, sf_dir, "part")
    fitted = tx.null_map_fields(tx.fit_arity(tx.split_line("p_name", " "), 3), "ring")
    return part.select("p_partkey", *tx.fields_to_columns(fitted, 3))


def dates_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: dates and timestamps printed the way each source dialect does."""
    from pyspark.sql import types as T

    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey",
        dt.dialect_text(d, T.DateType(), "oracle").alias("d_oracle"),
        dt.dialect_text(d, T.DateType(), "mysql").alias("d_mysql"),
        dt.dialect_text(F.col("o_orderdate"), T.TimestampNTZType(), "postgres").alias("ts_text"))


def _date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        F.date_format(d, "yyyyMMdd").alias("t1"),
        F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd"), F.lit(" ")).alias("t2"),
        F.date_format(d, "yyyyMMdd HH:mm:ss").alias("t3"),
        F.concat(F.lit("  "), F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("t4"),
        F.date_format(d + F.expr("INTERVAL 7 HOURS 5 MINUTES"), "HH:mm:ss").alias("t5"),
        F.col("o_orderpriority").alias("t6"),
        F.concat(F.date_format(d, "yyyy"), F.lit("13"), F.date_format(d, "dd")).alias("t7"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.date_format(d, "yyyy-MM-dd"))
        .alias("t8"))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date texts of many shapes parsed by the trial formats."""
    texts = _date_texts(spark, sf_dir)
    cols = [dt.format_ntz(dt.parse_dates(F.col(f"t{i}")), "yyyy-MM-dd HH:mm:ss").alias(f"p{i}")
            for i in range(1, 9)]
    return texts.select("o_orderkey", *cols)


def reformat_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text re-formatted; empty input gives empty output."""
    o = table(spark, sf_dir, "orders")
    src = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select(
        "o_orderkey",
        dt.reformat_date(src, "yyyy-MM-dd HH:mm:ss", "yyyyMMdd").alias("compact"),
        dt.timestamp_to_date(src, "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm").alias("day_only"))


def sanitize_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loader-safe text: backslashes doubled, separators removed,
    NULL as \\N."""
    d = table(spark, sf_dir, "documents")
    lang = F.when(F.col("lang") == "en", F.lit(None)).otherwise(F.col("lang"))
    return d.select("doc_id", tx.escape_load("text").alias("esc_text"),
                    tx.escape_load(lang).alias("esc_lang"),
                    tx.sanitize_load("source").alias("clean_source"))


def map_columns_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional fields mapped to target columns, a load variable
    used by a set expression, unlisted target columns NULL."""
    from loadbay.sinks.jdbc import map_columns, set_exprs

    text = tx.to_text_rows(dt.format_dates(table(spark, sf_dir, "orders"), "mysql").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority"))
    target = ["id", "cust", "status", "price_cents", "day", "priority", "note"]
    mapped = map_columns(text, ["id", "cust", "@price", "status", "day", "priority"], target)
    return set_exprs(mapped, "price_cents = cast(round(cast(@price as double) * 100) as bigint)",
                     target)


def typed_by_hive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event text typed by Hive type names; bad text -> NULL."""
    text = dt.dates_to_text(table(spark, sf_dir, "events"), "mysql")
    return tx.typed_by_hive(text, {"event_id": "bigint", "ts": "string", "user_id": "int",
                                   "event_type": "string", "value": "decimal(10,2)",
                                   "props": "int"})


def typed_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: lineitem text written as typed Parquet, read back."""
    li = table(spark, sf_dir, "lineitem")
    text = dt.dates_to_text(li, "mysql")
    path = sinks.write_parquet_typed(text, scratch(spark, "typedpq"), LINEITEM_TYPES)
    return spark.read.parquet(path)


def partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem text in flag/status folders; one flag read back,
    pruned at listing time."""
    from loadbay.sinks.catalog import write_partitioned

    li = table(spark, sf_dir, "lineitem")
    fields = [c for c in li.columns if c not in ("l_returnflag", "l_linestatus")]
    text = li.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in fields]).alias("value"),
                     "l_returnflag", "l_linestatus")
    root = write_partitioned(text, scratch(spark, "parts"), ["l_returnflag", "l_linestatus"])
    rows = sources.read_partition(spark, root, ["l_returnflag", "l_linestatus"], ["R", None],
                                  field_split="\t", num_fields=len(fields))
    return _typed_back(rows, {"_c0": "bigint", "_c1": "bigint", "_c2": "bigint", "_c3": "int", "_c4": "double",
                              "_c5": "double", "_c6": "double", "_c7": "double"})


def sharded_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over 16 shard folders t_00..t_15, read back as one
    data set with the shard name."""
    from loadbay.functions.names import expand_shards
    from loadbay.sources.shards import read_sharded_files

    o = table(spark, sf_dir, "orders")
    shard = F.concat(F.lit("t_"), F.lpad((F.col("o_orderkey") % 16).cast("string"), 2, "0"))
    root = scratch(spark, "shards")
    o.withColumn("shard", shard).write.partitionBy("shard").parquet(root)
    names = [f"shard={t}" for t in expand_shards("t_[00-15]")]
    df = read_sharded_files(spark, root, names, with_shard=True)
    return df.withColumn("_shard", F.regexp_replace("_shard", "^shard=", ""))


def route_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: rows routed to a target named after their source table."""
    from loadbay.sinks.catalog import route_shards as route

    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("_", "p_name", F.col("p_size").cast("string")).alias("src_table"))
    root = route(p, "src_table", scratch(spark, "routes"))
    back = spark.read.option("basePath", root).schema("p_partkey bigint, src_table string, target string") \
        .parquet(root)
    return back.groupBy("target").agg(F.count(F.lit(1)).alias("rows"))


def read_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text plus schema sidecar, read back with types."""
    o = table(spark, sf_dir, "orders")
    path = sinks.write_with_schema(o, scratch(spark, "withschema"))
    return sinks.read_with_schema(spark, path)


def print_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Console lines (prefix, separator, NULL text)."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("seg"))
    return sinks.format_rows(c, field_split="|", prefix=">> ", null_char="NULL")


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a user header, read back by header."""
    c = table(spark, sf_dir, "customer")
    path = sinks.write_files(c, scratch(spark, "csv"), file_format="csv",
                             header=["key", "name", "nation", "balance", "segment"], field_split=",",
                             write_mode="truncate")
    return (spark.read.option("header", "true").option("escape", '"')
            .schema("key string, name string, nation int, balance double, segment string").csv(path))


def sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's own SQL run by Spark, its result turned into text."""
    from loadbay.sources.catalog import read_query

    sql = (f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, "
           f"round(sum(o_totalprice), 2) AS total "
           f"FROM parquet.`{sf_dir}/orders.parquet` GROUP BY o_orderstatus, o_orderpriority;")
    out = tx.to_text_rows(read_query(spark, sql))
    return _typed_back(out, {"n": "bigint", "total": "double"})


def gbk_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as GBK text and read back as GBK; characters
    GBK cannot encode come back as ``?``."""
    d = table(spark, sf_dir, "documents")
    path = sinks.write_delimited(d, scratch(spark, "gbk"), field_split="\x01", encoding="GBK")
    return sources.read_delimited(spark, path, field_split="\x01", encoding="GBK", num_fields=5)


def remote_text_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer as headed text files (a header line in every file),
    read back with the header of each file dropped and \\N as NULL."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("seg"))
    path = sinks.write_files(c, scratch(spark, "remote"), file_format="text",
                             header=["key", "name", "nation", "balance", "segment"], field_split="\x01",
                             null_char="\\N")
    rows = sources.read_remote_text(spark, path, field_split="\x01", null_string="\\N",
                                    skip_header=True, num_fields=5)
    return _typed_back(rows, {"_c2": "int", "_c3": "double"})


def date_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 rows: order dates as text, parsed by positional masks (the first
    DATE column takes the first mask, the TIMESTAMP column the second plus
    fractional seconds)."""
    from loadbay.sinks.jdbc import prepare_rows_with_masks

    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("d"),
        F.concat(dt.format_ntz("o_orderdate", "yyyy-MM-dd HH:mm:ss."),
                 F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")).alias("ts"),
        F.col("o_orderpriority"))
    rows = prepare_rows_with_masks(o, ["number", "date", "timestamp", "varchar"],
                                   "yyyymmdd,yyyy-mm-dd hh24:mi:ss")
    return rows.select("o_orderkey", dt.format_ntz("d", "yyyy-MM-dd HH:mm:ss").alias("d"),
                       dt.format_ntz("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "o_orderpriority")


def columns_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed columns of orders under the user's condition; both
    reach the scan."""
    from loadbay.sources.catalog import read_query

    return read_query(spark, tables=f"parquet.`{sf_dir}/orders.parquet`",
                      columns="o_orderkey, o_totalprice, o_orderpriority",
                      where="o_orderstatus <> 'P' AND o_totalprice > 1000")


def expand_paths_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text in one folder per status; the files a glob root
    lists are met with the files the rows come from, rows counted per folder
    and depth."""
    o = table(spark, sf_dir, "orders")
    root = scratch(spark, "globbed")
    o.select(F.to_json(F.struct(*o.columns)).alias("value"), "o_orderstatus") \
        .write.partitionBy("o_orderstatus").text(root)
    listed = sources.expand_paths(spark, f"{root}/o_orderstatus=*", max_depth=1).select(
        F.substring_index("path", "/", -2).alias("file"), "depth")
    rows = spark.read.text(root).select(F.substring_index(F.col("_metadata.file_path"), "/", -2).alias("file"))
    # One grouping instead of a join: a file that was not listed has no depth.
    both = listed.withColumn("n", F.lit(0)).unionByName(
        rows.select("file", F.lit(None).cast("int").alias("depth"), F.lit(1).alias("n")))
    per_file = both.groupBy("file").agg(F.max("depth").alias("depth"), F.sum("n").alias("n"))
    return (per_file.where("depth is not null")
            .groupBy(F.regexp_extract("file", "=([^/]*)/", 1).alias("status"), "depth")
            .agg(F.sum("n").alias("rows")))


def _file_prefix(path: str) -> Column:
    """The prefix of a numbered file's path: ``prefix-0.txt`` where the folder
    has several, ``prefix.txt`` where it has one (the folder is named alike)."""
    folder = F.element_at(F.split(path, "/"), -2)
    name = F.element_at(F.split(path, "/"), -1)
    rest = F.substring(name, F.length(folder) + 1, F.length(name))
    return F.when(F.startswith(name, folder) & rest.rlike(r"^(-[0-9]+)?\.txt$"), folder).otherwise(F.lit(""))


def numbered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5/K6: orders written twice (the second write clears the first) as
    numbered files, as many as Spark writes by itself (``orders.txt`` where it
    is one), read back with the prefix of the file names."""
    o = dt.dates_to_text(table(spark, sf_dir, "orders"), "mysql")
    folder = scratch(spark, "numbered")
    for _ in range(2):
        path = sinks.write_delimited(o, folder, prefix="orders", del_mode=3, number_files=True)
    rows = sources.read_delimited(spark, path, field_split="\x01", num_fields=6, with_file=True)
    return _typed_back(rows.withColumn("_file", _file_prefix("_file")),
                       {"_c0": "bigint", "_c1": "bigint", "_c3": "double"})


def _rows_per_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and sum of the first field per prefix (sub-folder) of a folder."""
    lines = spark.read.text(f"{folder}/*").select("value", F.col("_metadata.file_path").alias("_file"))
    return (lines.groupBy(F.substring_index(F.substring_index("_file", "/", -2), "/", 1).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.substring_index("value", "\x01", 1).cast("bigint")).alias("keys")))


def shared_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two prefixes in one folder; the second load of orders clears only
    its own files, the third adds to them, customer's stay."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    folder = scratch(spark, "shared")
    for rows, prefix, mode in [(orders, "orders", {}), (customer, "customer", {"write_mode": "nonConflict"}),
                               (dt.dates_to_text(orders, "mysql"), "orders", {"del_mode": 3}),
                               (customer, "customer", {"write_mode": "append"})]:
        write_shared(rows, folder, prefix, **mode)
    lines = spark.read.text(folder).select(
        F.regexp_extract("_metadata.file_path", r"([a-z]+)[^/]*$", 1).alias("prefix"), "value")
    return lines.select("prefix", F.translate("value", "\x01", "|").alias("line"))


def del_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: two prefixes share a folder; mode 3 clears its own prefix only,
    mode 4 the whole folder."""
    c = table(spark, sf_dir, "customer")
    root = scratch(spark, "delmodes")
    for folder, last in (("own", 3), ("all", 4)):
        sinks.write_delimited(c, f"{root}/{folder}", prefix="a", del_mode=1)
        sinks.write_delimited(c, f"{root}/{folder}", prefix="b", del_mode=1)
        sinks.write_delimited(c, f"{root}/{folder}", prefix="b", del_mode=last)
    own, all_ = (_rows_per_prefix(spark, f"{root}/{f}").withColumn("folder", F.lit(f)) for f in ("own", "all"))
    return own.unionByName(all_)


def write_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written twice to each of two prefixes in one folder,
    truncated in one and appended in the other, and once under nonConflict."""
    c = table(spark, sf_dir, "customer")
    folder = scratch(spark, "writemodes")
    for mode, times in (("truncate", 2), ("append", 2), ("nonConflict", 1)):
        for _ in range(times):
            sinks.write_files(c, folder, prefix=mode, file_format="text", field_split="\x01", write_mode=mode)
    return _rows_per_prefix(spark, folder)


def load_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9b/K10 data file: documents written as a LOAD DATA file (\\001 / \\002,
    \\N, escaped backslashes), read back as the loader reads it."""
    from loadbay.sinks.jdbc import read_load_file, write_load_file

    d = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("lang") == "en", F.lit(None)).otherwise(F.col("lang")).alias("lang"),
        "source", "n_chars")
    path = write_load_file(d, scratch(spark, "loadfile"), "mysql")
    return read_load_file(spark, path, 5, "mysql")
