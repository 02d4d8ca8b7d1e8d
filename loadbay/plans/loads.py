"""Registered plans: key ranges, cells, load policies, quality, catalog and
streaming loads, each over the driver's whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadbay.functions import text as tx
from loadbay.operators import cells as cl
from loadbay.operators import policy as pol
from loadbay.operators import quality as q
from loadbay.operators import ranges as rg
from loadbay.plans.common import scratch, table
from loadbay.sinks import files as sinks
from loadbay.sources import files as sources


def key_range_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NTILE(200) key ranges of orders with exact sizes."""
    return rg.key_range_chunks(table(spark, sf_dir, "orders"), "o_orderkey", 200)


def key_range_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranges from histograms refined at the wanted ranks, without
    sorting the keys."""
    from loadbay.operators.bounds import key_range_select as select

    return select(table(spark, sf_dir, "orders"), "o_orderkey", 200)


def extent_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem in small row groups, packed into 8 chunks from the
    footers alone and read back chunk by chunk; all rows."""
    from loadbay.operators import extents as ex

    path = scratch(spark, "extents")
    table(spark, sf_dir, "lineitem").write.option("parquet.block.size", 64 * 1024).option(
        "parquet.page.size.row.check.min", 100).parquet(path)
    chunks = ex.extent_chunks(ex.file_extents(spark, path), 8)
    return ex.read_extents(spark, chunks, path, 8).drop("chunk")


def partition_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R13 per-partition mode: key range of orders per order status."""
    return rg.partition_ranges(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey")


def extent_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per "file" (supplier) the first block, end of the last extent
    and total length (block = orderkey*10 + linenumber, length = linenumber)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("block"),
        F.col("l_linenumber").alias("blocks"))
    return rg.extent_span(li, "l_suppkey", "block", "blocks")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region ranges over customer-name keys, one per nation: region i starts
    at customer 60*i (open start for the first, open end for the last)."""
    n = table(spark, sf_dir, "nation")

    def bound(k):
        return F.concat(F.lit("Customer#"), F.lpad((k * 60).cast("string"), 9, "0"))

    # nation has one row per nation: a window over all of it is tiny.
    last = F.max("n_nationkey").over(Window.partitionBy())
    return n.select(
        F.col("n_nationkey").alias("region"),
        F.when(F.col("n_nationkey") == 0, F.lit(None)).otherwise(bound(F.col("n_nationkey"))).alias("start"),
        F.when(F.col("n_nationkey") == last, F.lit(None)).otherwise(bound(F.col("n_nationkey") + 1))
        .alias("stop"))


def clip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region ranges clipped to the user's [start, stop)."""
    return cl.clip_ranges(_regions(spark, sf_dir), "Customer#000000100", "Customer#000001000") \
        .select("region", "clip_start", "clip_stop")


def key_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose text key lies in [start, stop)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return cl.key_range_filter(c, "c_name", "Customer#000000100", "Customer#000001000")


def rows_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows -> (rowkey, family, qualifier, value) cells; NULL
    cells are not written."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("seg"))
    cells, _dirty = cl.rows_to_cells(c, 0, ["info:name", "info:nation", "info:segment"])
    return cells.select("rowkey", "family", "qualifier", "value")


def _event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("rowkey"), F.lit("ev").alias("family"),
                    F.col("event_type").alias("qualifier"), F.col("event_id").alias("ts"),
                    F.col("props").alias("value"))


def cells_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K14 + R14: event cells (version = event id) loaded into a cell table,
    then the newest click/view/purchase cell per user as one row."""
    path = cl.write_cells(_event_cells(spark, sf_dir), scratch(spark, "cells"), del_mode=1)
    stored = spark.read.parquet(path)
    return cl.cells_to_rows(stored, ["ev:click", "ev:view", "ev:purchase"])


def _target_incoming(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("v"), F.lit(0).cast("bigint").alias("seq"))
    incoming = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("user_id") * 13)
        .cast("bigint").alias("id"),
        F.col("event_type").alias("v"), F.col("event_id").alias("seq"))
    return target, incoming


def load_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 IGNORE: first incoming row per new key added; NULL keys always."""
    target, incoming = _target_incoming(spark, sf_dir)
    return pol.load_with_key_policy(target, incoming, "id", "ignore", "seq")


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 REPLACE: last incoming row per key wins over the target."""
    target, incoming = _target_incoming(spark, sf_dir)
    return pol.load_with_key_policy(target, incoming, "id", "replace", "seq")


def load_files_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 on a file table: customer rows form the table's first version, the
    event batch is loaded under REPLACE into a fresh version that is swapped
    in; the table is read back."""
    target, incoming = _target_incoming(spark, sf_dir)
    path = scratch(spark, "filetable")
    target.write.parquet(path)
    pol.load_into_files(incoming, path, "id", "replace", "seq")
    return spark.read.parquet(path)


def load_buckets_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 on a key-bucketed file table: customer rows loaded first, then the
    event batch under REPLACE, rewriting only the buckets it touches."""
    target, incoming = _target_incoming(spark, sf_dir)
    path = scratch(spark, "buckets")
    pol.load_into_bucketed_files(target, path, "id", "ignore", "seq", buckets=16)
    pol.load_into_bucketed_files(incoming, path, "id", "replace", "seq", buckets=16)
    return spark.read.parquet(path).drop(pol.BUCKET_COL)


def load_versions_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 on a versioned file table: customer rows are its first version, the
    event batch is loaded under REPLACE as one epoch, and the epoch is replayed;
    the newest version is read."""
    from loadbay.operators.versions import load_version
    from loadbay.sinks.manifest import read_version

    target, incoming = _target_incoming(spark, sf_dir)
    root = scratch(spark, "versions")
    load_version(target, root, "id", "ignore", "seq")
    for _ in range(2):
        load_version(incoming, root, "id", "replace", "seq", epoch=1, writer="events")
    return read_version(spark, root)


def _two_key_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers with two unique keys (id and code), and events that meet them
    and each other under either one; some keys are NULL."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("code"), F.col("c_mktsegment").alias("v"),
        F.lit(0).cast("bigint").alias("seq"))
    number = F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(2000)).cast("string")
    incoming = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("user_id") * 13).cast("bigint").alias("id"),
        F.when(F.col("value") < 5, F.lit(None)).otherwise(
            F.concat(F.lit("Customer#"), F.lpad(number, 9, "0"))).alias("code"),
        F.col("event_type").alias("v"), F.col("event_id").alias("seq"))
    return target, incoming


def load_ignore_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 IGNORE with two unique keys: a row is added unless a row that is there
    shares either key."""
    from loadbay.operators.unique_keys import load_with_unique_keys

    target, incoming = _two_key_tables(spark, sf_dir)
    return load_with_unique_keys(target, incoming, [["id"], ["code"]], "ignore", "seq")


def load_replace_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 REPLACE with two unique keys: a row pushes out every row that shares
    either key."""
    from loadbay.operators.unique_keys import load_with_unique_keys

    target, incoming = _two_key_tables(spark, sf_dir)
    return load_with_unique_keys(target, incoming, [["id"], ["code"]], "replace", "seq")


def region_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event cells loaded into region files in two loads, the
    second beside the first, compacted to the newest version of each cell, and
    scanned over a range of row keys."""
    from loadbay.operators import regions

    cells = _event_cells(spark, sf_dir)
    root = scratch(spark, "regions")
    regions.write_regions(cells.where("ts % 2 = 0"), root, del_mode=1)
    regions.write_regions(cells.where("ts % 2 = 1"), root, del_mode=0)
    regions.compact_regions(spark, root)
    return regions.region_scan(spark, root, "12", "5")


def _event_rules():
    k = F.regexp_extract(F.col("props"), r"(\d+)", 1).try_cast("int")
    return {"k_high": k > 90, "low_value": F.col("value") < 2.0}


def split_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: events split into good and dirty rows; rows per reason."""
    e = table(spark, sf_dir, "events")
    marked = q.mark_dirty(e, _event_rules())
    return (marked.groupBy(F.coalesce(F.col(q.DIRTY_REASON), F.lit("good")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def check_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: error budgets (ratio and count, both loaders) over one aggregate."""
    e = table(spark, sf_dir, "events")
    marked = q.mark_dirty(e, _event_rules())
    agg = marked.agg(F.count(F.lit(1)).alias("rows"),
                     F.count_if(F.col(q.DIRTY_REASON).isNotNull()).alias("rejected"))
    limits = [(0.0, False), (0.05, False), (0.5, False), (100.0, False), (5000.0, False),
              (0.0, True), (0.05, True), (0.5, True), (100.0, True), (5000.0, True)]
    spec = F.explode(F.array(*[F.struct(F.lit(lim).alias("limit"), F.lit(inc).alias("inclusive"))
                               for lim, inc in limits])).alias("s")
    per = agg.select("rows", "rejected", spec)
    ok_exc = q.limit_ok(F.col("rows"), F.col("rejected"), F.col("s.limit"), inclusive=False)
    ok_inc = q.limit_ok(F.col("rows"), F.col("rejected"), F.col("s.limit"), inclusive=True)
    return per.select(F.col("s.limit").alias("limit"), F.col("s.inclusive").alias("inclusive"),
                      "rows", "rejected",
                      F.when(F.col("s.inclusive"), ok_inc).otherwise(ok_exc).alias("ok"))


def checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3+Q4 before commit: good event rows land in the target only because
    the dirty share stays within the 50% budget; the target is read back."""
    e = table(spark, sf_dir, "events")
    target = scratch(spark, "checked")
    q.load_checked(e, _event_rules(), 0.5, target, dirty_path=f"{target}_dirty")
    return spark.read.parquet(target)


def transfer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: rows, characters and derived byte figures of a documents load."""
    d = table(spark, sf_dir, "documents")
    return q.transfer_stats(d, is_dirty=F.col("n_chars") > 10000)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1/Q2: documents fanned out to three sinks from one read; the rows each
    sink holds are counted back and compared."""
    d = table(spark, sf_dir, "documents")
    root = scratch(spark, "fanout")
    targets = {"text": f"{root}/text", "gzip": f"{root}/gzip", "parquet": f"{root}/parquet"}
    q.fan_out(d, {
        "text": lambda df: sinks.write_delimited(df, targets["text"]),
        "gzip": lambda df: sinks.write_delimited(df, targets["gzip"], compression="gzip"),
        "parquet": lambda df: df.write.mode("overwrite").parquet(targets["parquet"]),
    })
    frames = {"text": spark.read.text(targets["text"]), "gzip": spark.read.text(targets["gzip"]),
              "parquet": spark.read.parquet(targets["parquet"])}
    return q.reconcile(q.count_sink_rows(frames))


def exchange_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 as one job: events checked by the dirty rules, the good rows fed
    to a text sink and a Parquet sink from one read, reconciled, reported."""
    e = table(spark, sf_dir, "events")
    root = scratch(spark, "exchange")
    return q.exchange(e, {
        "text": lambda df: sinks.write_delimited(df, f"{root}/text"),
        "parquet": lambda df: df.write.mode("overwrite").parquet(f"{root}/parquet"),
    }, rules=_event_rules(), limit=0.5)


def catalog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer loaded into a partition of an all-text catalog
    table (created when missing), then read back through the catalog."""
    import uuid

    from loadbay.sinks.catalog import load_hive
    from loadbay.sources.catalog import read_hive_location

    name = f"loadbay_k7_{uuid.uuid4().hex[:10]}"
    c = table(spark, sf_dir, "customer")
    load_hive(c, name, partition={"ds": "20240101"}, file_type="TXT",
              location=scratch(spark, "catalog"), pre=f"DROP TABLE IF EXISTS {name}")
    back = read_hive_location(spark, "", name, partition={"ds": "20240101"})
    return back.withColumn("c_acctbal", F.col("c_acctbal").try_cast("double"))


def catalog_load_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents loaded into an all-text catalog table and read
    back: only the separator and line ends of a text are replaced."""
    import uuid

    from loadbay.sinks.catalog import load_hive
    from loadbay.sources.catalog import read_hive_location

    name = f"loadbay_k7d_{uuid.uuid4().hex[:10]}"
    load_hive(table(spark, sf_dir, "documents"), name, file_type="TXT", location=scratch(spark, "catalogdocs"))
    return read_hive_location(spark, "", name)


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R17 + streaming fan-out: document lines arriving as text files are
    read as a stream, split, and written to two sinks per micro-batch."""
    from loadbay.streaming.lines import fan_out_stream, parquet_sink, read_line_stream

    root = scratch(spark, "stream")
    inbox = f"{root}/inbox"
    table(spark, sf_dir, "documents").select("text").write.text(inbox)
    stream = read_line_stream(spark, inbox, field_split="\x01", null_string="", num_fields=1)
    out_a, out_b = f"{root}/out_a", f"{root}/out_b"
    query = fan_out_stream(stream, {"a": parquet_sink(out_a), "b": parquet_sink(out_b)},
                           checkpoint=f"{root}/checkpoint")
    query.awaitTermination()
    got = [spark.read.schema("_c0 string, _epoch int").parquet(out).select("_c0") for out in (out_a, out_b)]
    odd = got[0].exceptAll(got[1]).unionAll(got[1].exceptAll(got[0]))
    return got[0].unionAll(odd)  # a row on one side only would show


def windowed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 over time: events arriving as files, rows, dirty rows, characters and
    speeds per hour; the hours that a delay of ten minutes has closed."""
    from loadbay.streaming import stats

    root = scratch(spark, "windowed")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/inbox")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/inbox")
    per_hour = stats.windowed_stats(stream, "ts", "1 hour", "10 minutes", is_dirty=F.col("value") < 2.0,
                                    columns=["event_type", "props"])
    stats.append_stats(per_hour, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(per_hour.schema).parquet(f"{root}/out")


def detect_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written as text, gzip text, Parquet and a SequenceFile;
    each folder's kind is detected from its files' first bytes and names, and
    the folder is read back with the reader of that kind."""
    c = table(spark, sf_dir, "customer")
    root = scratch(spark, "formats")
    sinks.write_delimited(c, f"{root}/txt")
    sinks.write_delimited(c, f"{root}/gz", compression="gzip")
    c.write.parquet(f"{root}/pq")
    sinks.write_sequence(c, f"{root}/seq", key_index=0)
    out = None
    for folder in ("txt", "gz", "pq", "seq"):
        path = f"{root}/{folder}"
        kind = sources.folder_kind(spark, path)
        rows = sources.read_detected(spark, path, num_fields=len(c.columns))
        one = rows.agg(F.count(F.lit(1)).alias("rows"),
                       F.count(F.col(rows.columns[1])).alias("names")).select(
            F.lit(folder).alias("folder"), F.lit(kind).alias("kind"), "rows", "names")
        out = one if out is None else out.unionByName(one)
    return out


def row_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row length (characters of non-NULL fields) per conversation turn."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", tx.row_length(["conv_id", "turn", "role", "text"])
                    .alias("row_len"))
