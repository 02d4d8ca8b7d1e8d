"""Load policies on a key (K9): MySQL ``LOAD DATA ... IGNORE / REPLACE``.

IGNORE keeps what the target has and adds, per new key, the *first*
incoming row; REPLACE lets the *last* incoming row per key win over the
target.  "First"/"last" follow an explicit order column (files have no
global order).  A NULL key never collides (a unique index admits many
NULLs), so every NULL-key row is inserted.

Scale: the per-key pick is an aggregate (``min_by``/``max_by``) with
map-side partial aggregation, so a hot key costs one row per map task
before the shuffle; the join that follows sees unique keys on both sides
and reuses the aggregate's partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.sinks.swap import swap_in

# The two duplicate-key policies; IGNORE is the default.
POLICIES = ("ignore", "replace")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def all_not_null(keys: Sequence[str]) -> Column:
    """Whether a key conflicts at all: none of its columns is NULL."""
    cond = None
    for k in keys:
        term = F.col(k).isNotNull()
        cond = term if cond is None else (cond & term)
    return cond


def pick_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                 last: bool) -> DataFrame:
    """One row per key: the first (``last=False``) or last row by
    ``order_col``; ties are broken by the remaining columns, so the pick is
    deterministic."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(order_col), *[F.col(c) for c in rest if c != order_col])
    pick = F.max_by if last else F.min_by
    picked = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(df.columns)


def load_with_key_policy(target: DataFrame, incoming: DataFrame, key: str | Sequence[str],
                         policy: str = "ignore", order_col: str | None = None) -> DataFrame:
    """K9: the target table after loading ``incoming`` under ``policy``.

    IGNORE adds the picked rows whose keys the target does not hold (an anti
    join against the target's keys); REPLACE keeps the target's rows whose
    keys were not picked and adds the picked ones.  NULL-key rows of either
    side take no part in the join and pass through unchanged.
    """
    policy = policy.lower()
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if order_col is None:
        raise ValueError("an order column is needed to tell first from last")
    keys = _keys(key)
    cols = target.columns
    incoming = incoming.select(cols)
    has_key = all_not_null(keys)
    null_key_rows = incoming.filter(~has_key)
    picked = pick_per_key(incoming.filter(has_key), keys, order_col, last=(policy == "replace"))
    if policy == "ignore":
        known = target.filter(has_key).select(*keys)
        return target.unionByName(picked.join(known, keys, "left_anti")).unionByName(null_key_rows)
    kept = target.filter(has_key).join(picked.select(*keys), keys, "left_anti").select(cols)
    return (kept.unionByName(target.filter(~has_key)).unionByName(picked).unionByName(null_key_rows))


def load_into_files(incoming: DataFrame, target_path: str, key: str | Sequence[str],
                    policy: str = "ignore", order_col: str | None = None,
                    fmt: str = "parquet", epoch: int | None = None) -> str:
    """K9 on a file table: the new version of the table is written to a
    fresh folder next to it and then swapped in by renames, so the job never
    overwrites the files it is reading and readers never see half a load.
    A missing target is created from the incoming rows under the policy.
    ``epoch`` is noted in the new version (``applied_epoch``)."""
    import uuid

    spark = incoming.sparkSession
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    target_p = jvm.org.apache.hadoop.fs.Path(target_path)
    fs = target_p.getFileSystem(conf)
    if fs.exists(target_p):
        target = spark.read.format(fmt).load(target_path)
    else:
        target = incoming.limit(0)
    result = load_with_key_policy(target, incoming, key, policy, order_col)
    tag = uuid.uuid4().hex[:12]
    fresh = f"{target_path.rstrip('/')}._new_{tag}"
    result.write.format(fmt).mode("errorifexists").save(fresh)
    if epoch is not None:
        note_epoch(spark, fresh, epoch)
    swap_in(spark, fresh, target_path)
    return target_path


#: Beside the data files: the last streaming epoch that a table holds.
EPOCH_NOTE = "_applied_epoch"


def note_epoch(spark: SparkSession, path: str, epoch: int) -> None:
    note = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, EPOCH_NOTE)  # noqa: SLF001
    fs = note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    out = fs.create(note, True)
    out.writeBytes(f"{epoch}\n")
    out.close()


def applied_epoch(spark: SparkSession, path: str) -> int | None:
    """The last epoch noted in a file table, or None."""
    note = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, EPOCH_NOTE)  # noqa: SLF001
    fs = note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(note):
        return None
    held = fs.open(note)
    try:
        return int(held.readLine())
    finally:
        held.close()


BUCKET_COL = "_bucket"
BUCKET_COUNT = "_bucket_count"


def _same_buckets(fs, marker, buckets: int) -> None:
    """Note the table's bucket count beside its buckets; another count is an error."""
    if fs.exists(marker):
        held = fs.open(marker)
        known = int(held.readLine())
        held.close()
        if known != buckets:
            raise ValueError(f"the table has {known} buckets, not {buckets}")
        return
    out = fs.create(marker)
    out.writeBytes(f"{buckets}\n")
    out.close()


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row: hash of its key columns; NULL keys (never matched,
    always inserted) get the extra bucket ``buckets``."""
    return F.when(all_not_null(keys),
                  F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))
                  ).otherwise(F.lit(buckets)).cast("int")


def load_into_bucketed_files(incoming: DataFrame, target_path: str, key: str | Sequence[str],
                             policy: str = "ignore", order_col: str | None = None,
                             buckets: int = 256) -> list[int]:
    """K9 on a file table stored as ``_bucket=<hash of key>`` folders: only
    the buckets the batch touches are read (partition pruning), merged under
    the policy, written aside and swapped in bucket by bucket.  A batch that
    touches few keys rewrites few buckets, however big the table is.
    Returns the buckets that were rewritten (at most ``buckets + 1``)."""
    import uuid

    spark = incoming.sparkSession
    keys = _keys(key)
    tagged = incoming.withColumn(BUCKET_COL, key_bucket(keys, buckets))
    # The touched buckets: at most buckets + 1 numbers, a fixed bound.
    touched = sorted(r[0] for r in tagged.select(BUCKET_COL).distinct().collect())
    if not touched:
        return []
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    Path = jvm.org.apache.hadoop.fs.Path
    root = Path(target_path)
    fs = root.getFileSystem(conf)
    _same_buckets(fs, Path(root, BUCKET_COUNT), buckets)
    cols = incoming.columns
    # NULL keys match nothing: their bucket is appended to, never rewritten.
    null_keys = tagged.filter(F.col(BUCKET_COL) == buckets)
    tagged = tagged.filter(F.col(BUCKET_COL) < buckets)
    keyed = [b for b in touched if b < buckets]
    if any(fs.exists(Path(root, f"{BUCKET_COL}={b}")) for b in keyed):
        current = (spark.read.option("basePath", target_path).parquet(target_path)
                   .filter(F.col(BUCKET_COL).isin(keyed)))
        target = current.select(*cols, BUCKET_COL)
    else:
        target = tagged.limit(0)
    merged = load_with_key_policy(target, tagged.select(*cols, BUCKET_COL), keys, policy, order_col)
    tag = uuid.uuid4().hex[:12]
    staging = f"{target_path.rstrip('/')}._new_{tag}"
    merged.write.partitionBy(BUCKET_COL).mode("errorifexists").parquet(staging)
    fs.mkdirs(root)
    for b in keyed:
        name = f"{BUCKET_COL}={b}"
        fresh, live, old = Path(f"{staging}/{name}"), Path(root, name), Path(root, f".old_{tag}_{b}")
        had = fs.exists(live)
        if had and not fs.rename(live, old):
            raise RuntimeError(f"could not move {name} aside")
        if fs.exists(fresh):
            if not fs.rename(fresh, live):
                if had:
                    fs.rename(old, live)
                raise RuntimeError(f"could not move the new {name} in")
        if had:
            fs.delete(old, True)
    fs.delete(Path(staging), True)
    if len(keyed) < len(touched):
        null_keys.select(cols).write.mode("append").parquet(f"{target_path.rstrip('/')}/{BUCKET_COL}={buckets}")
    return touched
