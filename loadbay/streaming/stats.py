"""Transfer statistics over time (Q5): rows, characters and speeds per interval.

The intervals are event-time windows of a stream with a watermark: a window is
given out once, when no row of it is awaited any more, and its running sums are
state that the checkpoint keeps, so a restarted query goes on where it stopped
and repeats no window.  A row that comes after its window was given out is not
counted there; such rows are counted apart (``late_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadbay.functions import text as tx
from loadbay.operators.quality import line_speed_text, speed_text


def windowed_stats(stream: DataFrame, time_col: str, interval: str, delay: str = "0 seconds",
                   is_dirty: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """One row per interval: start, end, read_rows, discard_rows, write_rows,
    chars (of the non-NULL ``columns``, all but the time by default), byte_speed
    and line_speed over the interval.

    ``delay`` is how late a row may come.  Rows without a time have no
    interval.  State is one row of sums per open interval.  A time without a
    zone is taken, and given back, as it stands."""
    zoneless = isinstance(stream.schema[time_col].dataType, T.TimestampNTZType)
    names = columns if columns is not None else [c for c in stream.columns if c != time_col]
    dirty = F.coalesce(is_dirty, F.lit(False)) if is_dirty is not None else F.lit(False)
    length = tx.row_length([F.col(f"`{c}`") for c in names]) if names else F.lit(0)
    time = F.col(f"`{time_col}`")
    if zoneless:
        time = F.make_timestamp_ltz(F.year(time), F.month(time), F.day(time), F.hour(time), F.minute(time),
                                    F.date_part(F.lit("SECOND"), time), F.lit("UTC"))
    sums = (stream.withColumn("_time", time).withWatermark("_time", delay).groupBy(F.window("_time", interval).alias("w"))
            .agg(F.count(F.lit(1)).alias("read_rows"), F.count_if(dirty).alias("discard_rows"),
                 F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("chars")))
    seconds = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end"))
    start, end = F.col("w.start"), F.col("w.end")
    if zoneless:
        start, end = (F.expr(f"timestampadd(MICROSECOND, unix_micros(w.{x}), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
                      for x in ("start", "end"))
    return sums.select(
        start.alias("start"), end.alias("end"), "read_rows", "discard_rows",
        (F.col("read_rows") - F.col("discard_rows")).alias("write_rows"), "chars",
        speed_text(F.col("chars"), seconds).alias("byte_speed"),
        line_speed_text(F.col("read_rows"), seconds).alias("line_speed"))


def append_stats(stats: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append every finished interval to Parquet at ``path``, exactly once."""
    w = stats.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows the query has left out because their interval was given out
    before, over the progress reports Spark still holds."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)
