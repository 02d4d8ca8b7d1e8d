"""Line streams (R17) and streaming fan-out to many sinks (Q1 streaming).

The reference's stdin reader becomes an unbounded folder of text files read
with Structured Streaming; every micro-batch goes through the same Column
rules as the batch readers and, with ``foreachBatch``, to every sink.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadbay.sources.files import lines_to_rows


def read_line_stream(spark: SparkSession, dir_: str, field_split: str = "\t",
                     null_string: str | None = "", num_fields: int | None = None,
                     col_filter: str | None = None, legacy_last_field: bool = False,
                     max_files_per_trigger: int | None = None,
                     encoding: str = "utf-8") -> DataFrame:
    """New text files in ``dir_`` -> rows, split like R1 (``encoding``
    other than UTF-8 decodes each line first).

    ``legacy_last_field`` keeps the last field out of NULL mapping, as the
    line-stream reader did.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.load(dir_)
    if encoding.lower().replace("-", "") != "utf8":
        from loadbay.functions.text import decode_text
        from loadbay.sources.files import enable_java_charsets

        enable_java_charsets(spark)
        # Lines are cut on raw bytes and decoded before any field split.
        lines = lines.select(decode_text(F.col("value"), encoding).alias("value"))
    return lines_to_rows(lines, field_split, null_string, col_filter, num_fields,
                         keep_last=legacy_last_field)


def fan_out_stream(stream: DataFrame, sinks: Mapping[str, Callable[[DataFrame, int], object]],
                   checkpoint: str, available_now: bool = True,
                   stats_path: str | None = None, rules: Mapping[str, Column] | None = None,
                   dirty_path: str | None = None) -> StreamingQuery:
    """Every micro-batch to every sink (``foreachBatch``); the batch is
    persisted once per epoch so the source is read once.  The checkpoint
    (a shared folder) makes a restarted query resume where it stopped.

    ``rules`` set dirty rows aside per epoch (Q3): the sinks get the good
    rows, ``dirty_path`` (if given) the dirty ones with their reason.
    ``stats_path`` appends one row of transfer statistics (Q5) per epoch,
    with the dirty rows counted as discarded and the number of sinks.
    """
    from loadbay.operators.quality import DIRTY_REASON, mark_dirty

    def each(batch: DataFrame, epoch: int) -> None:
        marked = mark_dirty(batch, rules or {}).persist()
        try:
            good = marked.filter(F.col(DIRTY_REASON).isNull()).drop(DIRTY_REASON)
            for sink in sinks.values():
                sink(good, epoch)
            if dirty_path and rules:
                (marked.filter(F.col(DIRTY_REASON).isNotNull())
                 .write.mode("overwrite").parquet(f"{dirty_path.rstrip('/')}/_epoch={epoch}"))
            if stats_path:
                stats = _epoch_stats(marked, batch.columns, bool(rules))
                (stats.select("*", F.lit(len(sinks)).alias("sinks"))
                 .write.mode("overwrite").parquet(f"{stats_path.rstrip('/')}/epoch={epoch}"))
        finally:
            marked.unpersist()

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _epoch_stats(marked: DataFrame, columns: list[str], has_rules: bool) -> DataFrame:
    """Q5 of one epoch over its original columns, dirty rows as discards."""
    from loadbay.functions.text import row_length
    from loadbay.operators.quality import DIRTY_REASON

    dirty = F.col(DIRTY_REASON).isNotNull() if has_rules else F.lit(False)
    agg = marked.agg(F.count(F.lit(1)).alias("read_rows"),
                     F.count_if(dirty).alias("discard_rows"),
                     F.coalesce(F.sum(row_length([F.col(f"`{c}`") for c in columns])),
                                F.lit(0)).cast("bigint").alias("chars"))
    return agg.select("read_rows", "discard_rows",
                      (F.col("read_rows") - F.col("discard_rows")).alias("write_rows"), "chars")


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink writing each epoch to its own ``_epoch=N``
    folder, so a replayed epoch overwrites itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_epoch={epoch}")

    return write


def key_policy_sink(path: str, key: str | list[str], policy: str = "replace",
                    order_col: str | None = None,
                    buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that loads each micro-batch into a file table
    under IGNORE / REPLACE (K9), one swapped-in version per epoch.  With
    ``buckets`` the table is key-bucketed and an epoch rewrites only the
    buckets its rows touch.

    The table notes the last epoch it has applied, and a replayed one is not
    applied again.  The note of a plain table moves in with its version; that
    of a bucketed one is written after the load, so a failure just between
    the two replays the epoch (NULL keys twice).  ``version_sink`` has no such
    gap."""
    from loadbay.operators.policy import applied_epoch, load_into_bucketed_files, load_into_files, note_epoch

    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        last = applied_epoch(spark, path)
        if last is not None and epoch <= last:
            return
        if buckets:
            load_into_bucketed_files(batch, path, key, policy, order_col, buckets)
            note_epoch(spark, path, epoch)
        else:
            load_into_files(batch, path, key, policy, order_col, epoch=epoch)

    return load


def version_sink(root: str, key: str | list[str], policy: str = "replace", order_col: str | None = None,
                 writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that loads each micro-batch into a versioned file
    table (``operators.versions``): rows and epoch are published at once, and an
    epoch rewrites only files that hold one of its keys."""
    from loadbay.operators.versions import load_version

    def load(batch: DataFrame, epoch: int) -> None:
        load_version(batch, root, key, policy, order_col, epoch=epoch, writer=writer)

    return load


def print_sink(field_split: str = "\t", prefix: str = "",
               null_char: str = "") -> Callable[[DataFrame, int], None]:
    """K15 for streams: a ``foreachBatch`` sink printing each micro-batch's
    rows as lines (prefix, separator, NULL text) on the executors."""
    from loadbay.sinks.files import print_rows

    def show(batch: DataFrame, epoch: int) -> None:
        print_rows(batch, field_split, prefix, null_char)

    return show
