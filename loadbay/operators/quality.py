"""Load quality (Q1-Q5): fan-out, reconciliation, dirty rows, error budget,
transfer statistics.

Counts come from aggregates or ``Observation``s of the very job that writes,
so no extra pass over the data is made just to count it.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, wait

import pyarrow as pa
from pyspark import AccumulatorParam, StorageLevel, TaskContext, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from loadbay.session import written
from loadbay.sinks.swap import swap_in
from loadbay.functions import text as tx

DIRTY_REASON = "_dirty_reason"


# --------------------------------------------------------------------------
# Q3: dirty rows
# --------------------------------------------------------------------------

def type_rules(types: Mapping[str, str]) -> dict[str, Column]:
    """One rule per typed column: non-empty text that does not convert."""
    return {f"bad_{c}": tx.bad_cast(F.col(f"`{c}`"), t) for c, t in types.items()}


def mark_dirty(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``_dirty_reason``: the name of the first rule a row breaks, or NULL."""
    reason = F.lit(None).cast("string")
    for name, cond in reversed(list(rules.items())):
        reason = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn(DIRTY_REASON, reason)


def split_dirty(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q3: ``(good, dirty)``; ``dirty`` carries ``_dirty_reason``.

    Both are filters over one marked frame; persist ``df`` first when both
    are written and the source is expensive to read twice.
    """
    marked = mark_dirty(df, rules)
    good = marked.filter(F.col(DIRTY_REASON).isNull()).drop(DIRTY_REASON)
    dirty = marked.filter(F.col(DIRTY_REASON).isNotNull())
    return good, dirty


def dirty_summary(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(reason, rows)`` for every rule that caught a row (one aggregate)."""
    marked = mark_dirty(df, rules)
    return (marked.filter(F.col(DIRTY_REASON).isNotNull())
            .groupBy(F.col(DIRTY_REASON).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


# --------------------------------------------------------------------------
# Q4: error budget
# --------------------------------------------------------------------------

def limit_ok(rows: Column, rejected: Column, limit: Column, inclusive: bool = False) -> Column:
    """Error budget as a Column.

    ``inclusive=False`` (direct-path loader): no rows -> ok; limit 0 -> no
    limit; limit < 1 is a ratio (ok if rejected/rows <= limit); limit >= 1 is
    a count (ok if rejected <= limit).
    ``inclusive=True`` (LOAD DATA loader): fails as soon as rejected reaches
    the limit (ratio: rejected/rows reaches it); limit 0 -> no limit.
    """
    ratio = rejected.cast("double") / rows.cast("double")
    if not inclusive:
        return (F.when(rows == 0, True)
                 .when(limit == 0, True)
                 .when(limit < 1, ratio <= limit)
                 .otherwise(rejected <= limit))
    return (F.when(limit == 0, True)
             .when(rows == 0, True)
             .when(limit < 1, ratio < limit)
             .otherwise(rejected < limit))


def check_limit(df: DataFrame, is_bad: Column, limit: float, inclusive: bool = False) -> DataFrame:
    """Q4: one row ``(rows, rejected, limit, ok)`` from one aggregate."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.coalesce(is_bad, F.lit(False))).alias("rejected"))
    return agg.select("rows", "rejected", F.lit(float(limit)).alias("limit"),
                      limit_ok(F.col("rows"), F.col("rejected"), F.lit(float(limit)),
                               inclusive).alias("ok"))


# --------------------------------------------------------------------------
# Q5: transfer statistics
# --------------------------------------------------------------------------

# Units of the speed texts, largest first.
SPEED_UNITS = ((1_000_000, "MB/s"), (1_000, "KB/s"), (1, "B/s"))
LINE_UNITS = ((1, "L/s"),)


def _per_second(amount: Column, seconds: Column, units: tuple[tuple[int, str], ...]) -> Column:
    """``amount`` per second in the largest unit that gives at least 1.

    Whole seconds, at least one; something moved counts as at least 1."""
    rate = F.floor(amount.cast("bigint") / F.greatest(seconds, F.lit(1)).cast("bigint"))
    rate = F.greatest(rate, F.least(amount, F.lit(1)).cast("bigint"))
    shown = [F.when(rate >= size, F.concat(F.floor(rate / size).cast("string"), F.lit(name)))
             for size, name in units]
    return F.coalesce(*shown, F.concat(rate.cast("string"), F.lit(units[-1][1])))


def speed_text(amount: Column, seconds: Column) -> Column:
    """Bytes per second as ``nMB/s``, ``nKB/s`` or ``nB/s`` (steps of 1000)."""
    return _per_second(amount, seconds, SPEED_UNITS)


def line_speed_text(lines: Column, seconds: Column) -> Column:
    """Rows per second as ``nL/s``."""
    return _per_second(lines, seconds, LINE_UNITS)


def transfer_stats(df: DataFrame, is_dirty: Column | None = None,
                   seconds: float | None = None) -> DataFrame:
    """Q5: one row of transfer statistics from one aggregate.

    ``chars`` counts the characters of all non-NULL fields (the "bytes" of
    the reports); ``avg_len`` is integer-divided; write = read - discard;
    byte figures derive from the average as the job report does.
    """
    length = tx.row_length([F.col(f"`{c}`") for c in df.columns])
    dirty = F.coalesce(is_dirty, F.lit(False)) if is_dirty is not None else F.lit(False)
    agg = df.agg(F.count(F.lit(1)).alias("read_rows"),
                 F.count_if(dirty).alias("discard_rows"),
                 F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("chars"))
    avg = F.when(F.col("read_rows") != 0,
                 (F.col("chars") / F.col("read_rows")).cast("bigint")).otherwise(F.lit(0))
    out = agg.select(
        "read_rows", "discard_rows",
        (F.col("read_rows") - F.col("discard_rows")).alias("write_rows"),
        "chars", avg.alias("avg_len"))
    out = out.select(
        "*",
        (F.col("read_rows") * F.col("avg_len")).alias("read_bytes"),
        (F.col("write_rows") * F.col("avg_len") - F.col("discard_rows")).alias("write_bytes"),
        (F.col("discard_rows") * F.col("avg_len")).alias("discard_bytes"))
    if seconds is not None:
        s = F.lit(int(seconds))
        out = out.select("*", speed_text(F.col("chars"), s).alias("byte_speed"),
                         line_speed_text(F.col("read_rows"), s).alias("line_speed"))
    return out


# --------------------------------------------------------------------------
# Q1 / Q2: fan-out and reconciliation
# --------------------------------------------------------------------------

Sink = Callable[[DataFrame], object]


def fan_out(df: DataFrame, sinks: Mapping[str, Sink], on_sink_error: str = "fail",
            storage: StorageLevel = StorageLevel.DISK_ONLY,
            materialize: str = "checkpoint", parallel: bool = True) -> dict[str, int | None]:
    """Q1: one read, every sink gets every row.

    ``materialize="checkpoint"`` writes the source once to the shared
    ``spark.checkpoint.dir``, so no sink ever re-reads the source, even after
    executors are lost; ``"persist"`` keeps it on the executors' disks instead
    (a lost executor's blocks are recomputed from lineage).  Each sink runs
    one write job observed for its row count.  Sinks run side by side, each
    from a thread, a job group and (under the fair scheduler) a pool of its
    own; ``parallel=False`` runs them one after the other.

    ``on_sink_error="drop"`` cancels the jobs of a failing sink alone, and lets
    the others finish (its count is ``None``); ``"fail"`` cancels them all.
    """
    if on_sink_error not in ("fail", "drop"):
        raise ValueError("on_sink_error is 'fail' or 'drop'")
    if materialize not in ("persist", "checkpoint"):
        raise ValueError("materialize is 'persist' or 'checkpoint'")
    spark = df.sparkSession
    if materialize == "checkpoint":
        from loadbay.session import checkpoint_root

        checkpoint_root(spark)
        src = df.checkpoint(eager=True)
    else:
        src = df.persist(storage)
        if parallel:  # filled once, before the sinks race for it
            src.write.format("noop").mode("overwrite").save()
    sc = spark.sparkContext
    run = uuid.uuid4().hex[:8]
    groups = {name: f"fan_out_{run}_{i}" for i, name in enumerate(sinks)}
    stopped = threading.Event()

    def feed(name: str) -> int | None:
        if stopped.is_set():
            return None
        sc.setLocalProperty("spark.scheduler.pool", groups[name])
        sc.setJobGroup(groups[name], f"sink {name}", interruptOnCancel=True)
        obs = Observation(groups[name])
        try:
            sinks[name](src.observe(obs, F.count(F.lit(1)).alias("rows")))
            return int(obs.get["rows"])
        except Exception:
            sc.cancelJobGroup(groups[name])
            if on_sink_error == "drop":
                return None
            stopped.set()
            for group in groups.values():
                sc.cancelJobGroup(group)
            raise

    try:
        # A thread of its own in any case: job group and pool end with it.
        with ThreadPoolExecutor(len(sinks) if parallel and sinks else 1) as pool:
            running = {name: pool.submit(inheritable_thread_target(spark)(feed), name) for name in sinks}
        # All are done: the error of the sink that failed, not of those it stopped.
        failed = [f.exception() for f in running.values() if f.exception()]
        if failed:
            raise next((e for e in failed if "cancel" not in str(e).lower()), failed[0])
        return {name: f.result() for name, f in running.items()}
    finally:
        if materialize == "persist":
            src.unpersist()


def reconcile(counts: DataFrame) -> DataFrame:
    """Q2: ``(sink, rows, ok)``: a sink is ok when every sink took the same
    number of rows (sinks are compared with each other).  The input has one
    row per sink, so the un-partitioned window is over a handful of rows."""
    w = Window.partitionBy()
    same = (F.min("rows").over(w) == F.max("rows").over(w)) & (
        F.count_if(F.col("rows").isNull()).over(w) == 0)
    return counts.select("sink", "rows", F.coalesce(same, F.lit(False)).alias("ok"))


def status_code(reconciled: DataFrame) -> DataFrame:
    """0 when all sinks agree, 200 ("partly failed") otherwise."""
    return reconciled.agg(F.when(F.bool_and("ok"), F.lit(0)).otherwise(F.lit(200)).alias("code"))


def count_sink_rows(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per sink, counted by Spark from what each sink holds."""
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sink"), "rows")
             for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------
# Q3 + Q4 before commit: a load that only lands when the budget holds
# --------------------------------------------------------------------------

class LoadRejected(RuntimeError):
    """The error budget was exceeded; nothing was committed."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


class _PerPartition(AccumulatorParam):
    """Numbers by partition; a partition that runs again counts once."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, one: dict, other: dict) -> dict:  # noqa: N802 - PySpark's name
        for k, n in other.items():
            one[k] = max(one.get(k, 0), n)
        return one


def _counting(counter):
    """Pass rows through and count the dirty ones of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dirty = 0
        for batch in batches:
            dirty += batch.num_rows - batch.column(batch.schema.get_field_index(DIRTY_REASON)).null_count
            yield batch
        if dirty:
            counter.add({TaskContext.get().partitionId(): dirty})
    return run


def _run_watched(spark: SparkSession, job: Callable[[], None], broken: Callable[[], bool], every: float = 0.2) -> bool:
    """Run a job in a job group of its own and cancel it as soon as ``broken``
    says so; whether it ran to its end."""
    sc = spark.sparkContext
    group = f"watched_{uuid.uuid4().hex[:12]}"

    def run() -> None:
        sc.setJobGroup(group, "load with an error budget", interruptOnCancel=True)
        job()

    with ThreadPoolExecutor(1) as pool:
        running = pool.submit(inheritable_thread_target(spark)(run))
        while not running.done():
            if broken():
                sc.cancelJobGroup(group)
                running.exception()
                return False
            wait([running], timeout=every)
        running.result()
    return True


def load_checked(df: DataFrame, rules: Mapping[str, Column], limit: float, target: str,
                 fmt: str = "parquet", inclusive: bool = False, dirty_path: str | None = None,
                 options: Mapping[str, str] | None = None, stop_early: bool = False,
                 expected_rows: int | None = None) -> dict[str, object]:
    """Write the good rows of ``df`` to ``target`` only if the dirty rows stay
    within ``limit`` (Q4 rules); otherwise raise :class:`LoadRejected`.

    Good rows are written by one job into a staging folder next to the
    target; the same job counts all rows and dirty rows (an observation
    placed before the filter).  The target is moved aside, the staging folder
    moved in, and the old target deleted; if a move fails the old target is
    put back and the staged load is kept.  Readers never see a partial or
    rejected load, but for the moment between two renames there is none.  ``dirty_path``
    also keeps the dirty rows with their reason (the marked rows are
    written once to the shared scratch folder for that second write).

    ``stop_early`` ends the job as soon as the finished tasks hold more dirty
    rows than the budget allows: a count limit, or a ratio of ``expected_rows``
    (with more rows than expected a ratio is judged at the end only).  It costs a
    pass of the rows through Arrow.
    """
    spark = df.sparkSession
    marked = mark_dirty(df, rules)
    if dirty_path:
        marked = written(marked, "checked-marked")
    obs = Observation(f"load_checked_{uuid.uuid4().hex[:8]}")
    observed = marked.observe(obs, F.count(F.lit(1)).alias("rows"),
                              F.count_if(F.col(DIRTY_REASON).isNotNull()).alias("rejected"))
    budget = None
    if stop_early and limit > 0:
        budget = limit if limit >= 1 else limit * expected_rows if expected_rows else None
    if budget is not None:
        counter = spark.sparkContext.accumulator({}, _PerPartition())
        observed = observed.mapInArrow(_counting(counter), observed.schema)
    staging = f"{target.rstrip('/')}._staging_{uuid.uuid4().hex[:12]}"
    good = observed.filter(F.col(DIRTY_REASON).isNull()).drop(DIRTY_REASON)
    write = good.write.format(fmt).options(**(options or {})).mode("errorifexists")
    fs, stage_p = _fs(spark, staging)
    try:
        if budget is None:
            write.save(staging)
        else:
            seen = lambda: sum(counter.value.values())
            broken = lambda: seen() >= budget if inclusive else seen() > budget
            if not _run_watched(spark, lambda: write.save(staging), broken):
                raise LoadRejected(f"stopped at {seen()} rejected rows, limit {limit}")
        rows, rejected = int(obs.get["rows"]), int(obs.get["rejected"])
        if not spark.range(1).select(limit_ok(F.lit(rows), F.lit(rejected), F.lit(float(limit)), inclusive)).first()[0]:
            raise LoadRejected(f"{rejected} of {rows} rows rejected, limit {limit}")
        if dirty_path:
            marked.filter(F.col(DIRTY_REASON).isNotNull()).write.mode("overwrite").parquet(dirty_path)
        swap_in(spark, staging, target)
    except LoadRejected:
        fs.delete(stage_p, True)
        raise
    return {"rows": rows, "rejected": rejected, "ok": True, "target": target}


# --------------------------------------------------------------------------
# One exchange: read once, check rows, fan out, reconcile, report
# --------------------------------------------------------------------------

def exchange(df: DataFrame, sinks: Mapping[str, Sink], rules: Mapping[str, Column] | None = None,
             limit: float | None = None, inclusive: bool = False,
             seconds: float | str | None = None,
             materialize: str = "checkpoint", on_sink_error: str = "fail",
             measure_chars: bool = True) -> DataFrame:
    """A whole transfer job: dirty rows set aside (Q3), every sink fed from
    one read (Q1), sinks reconciled (Q2), error budget (Q4) and statistics
    (Q5) reported.

    Read counts and characters come from an observation on the source rows,
    taken by the same job that feeds the first sink; nothing is scanned just
    to count.  Returns one report row per sink: ``sink, rows, ok, read_rows,
    discard_rows, chars, budget_ok, code`` (``code`` 0 when every sink took
    every good row and the budget holds, else 200).  ``measure_chars=False``
    skips the character count (it prints every field as text once).
    ``seconds`` adds byte and line speeds: a number of seconds, or
    ``"measure"`` for the wall time of the transfer itself.
    """
    spark = df.sparkSession
    cols = list(df.columns)
    marked = mark_dirty(df, rules or {})
    obs = Observation(f"exchange_{uuid.uuid4().hex[:8]}")
    observed = marked.observe(
        obs, F.count(F.lit(1)).alias("read_rows"),
        F.count_if(F.col(DIRTY_REASON).isNotNull()).alias("discard_rows"),
        (F.coalesce(F.sum(tx.row_length([F.col(f"`{c}`") for c in cols])), F.lit(0))
         if measure_chars else F.lit(0)).cast("bigint").alias("chars"))
    good = observed.filter(F.col(DIRTY_REASON).isNull()).drop(DIRTY_REASON)
    import time

    started = time.monotonic()
    counts = fan_out(good, sinks, on_sink_error=on_sink_error, materialize=materialize)
    if seconds == "measure":
        seconds = time.monotonic() - started
    m = obs.get
    read_rows, discard, chars = int(m["read_rows"]), int(m["discard_rows"]), int(m["chars"])
    expected = read_rows - discard
    rows = spark.createDataFrame([(k, v) for k, v in counts.items()], "sink string, rows bigint")
    budget = (limit_ok(F.lit(read_rows), F.lit(discard), F.lit(float(limit)), inclusive)
              if limit is not None else F.lit(True))
    report = rows.select(
        "sink", "rows", F.coalesce(F.col("rows") == F.lit(expected), F.lit(False)).alias("ok"),
        F.lit(read_rows).cast("bigint").alias("read_rows"),
        F.lit(discard).cast("bigint").alias("discard_rows"),
        F.lit(chars).cast("bigint").alias("chars"), budget.alias("budget_ok"))
    if seconds is not None:
        report = report.select("*", speed_text(F.col("chars"), F.lit(int(seconds))).alias("byte_speed"),
                               line_speed_text(F.col("read_rows"), F.lit(int(seconds)))
                               .alias("line_speed"))
    w = Window.partitionBy()  # one row per sink
    return report.withColumn(
        "code", F.when(F.bool_and(F.col("ok") & F.col("budget_ok")).over(w), F.lit(0))
        .otherwise(F.lit(200)))
