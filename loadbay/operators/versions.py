"""K9 on a versioned file table: IGNORE only adds files, REPLACE rewrites only
the files that hold a key of the batch, and an epoch is applied once.

The table is a manifest of immutable files (``sinks.manifest``) dealt by key
range, so a batch of near keys meets few files.  What a load reads of the table
is the key column of the files whose range meets the batch's; what it rewrites
is the files with a key in common.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.operators.policy import POLICIES, all_not_null, pick_per_key
from loadbay.session import written
from loadbay.sinks import manifest as mf

FILE = "_of_file"


def load_version(incoming: DataFrame, root: str, key: str | Sequence[str], policy: str = "ignore",
                 order_col: str | None = None, epoch: int | None = None, writer: str = "load",
                 parts: int | None = None) -> mf.Version:
    """Load a batch under IGNORE / REPLACE and publish the next version.

    ``epoch`` makes the load repeatable: an epoch this ``writer`` has applied is
    not applied again, rows with NULL keys included.  The first load makes the
    table.  An empty batch publishes only its epoch.
    """
    policy = policy.lower()
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if order_col is None:
        raise ValueError("an order column is needed to tell first from last")
    spark = incoming.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    version = mf.current(spark, root)
    if version.applied(writer, epoch):
        return version
    if version.number and version.key != keys[0]:
        raise ValueError(f"the table's files are dealt by {version.key!r}, not {keys[0]!r}")
    schema = mf.read_files(spark, version).schema if version.number else incoming.schema
    incoming = incoming.select(schema.names)
    has_key = all_not_null(keys)
    picked = written(pick_per_key(incoming.where(has_key), keys, order_col, last=policy == "replace"), "version-picked")
    bare = incoming.where(~has_key)
    if not version.number:
        new = mf.add_files(picked.unionByName(bare), root, keys[0], keys, parts)
        return mf.publish(spark, version, new, keys[0], schema, writer, epoch)

    # The batch's range of the first key: two values.
    lo, hi = picked.agg(F.min(keys[0]), F.max(keys[0])).first()
    listed = mf.files(spark, version)
    if lo is None:
        meets = listed.limit(0)
    else:
        meets = mf.files_in_range(spark, version, lo, hi, closed=True)
    near = mf.read_files(spark, version, meets, FILE).where(has_key)
    if policy == "ignore":
        add = picked.join(near.select(*keys).hint("merge"), keys, "left_anti").select(schema.names)
        new = mf.add_files(add.unionByName(bare), root, keys[0], keys, parts)
        return mf.publish(spark, version, listed.unionByName(new), keys[0], schema, writer, epoch)
    touched = written(near.select(*keys, F.col(FILE).alias("file")).join(picked.select(*keys).hint("merge"), keys, "left_semi")
                      .select("file").distinct(), "version-touched")
    old = mf.read_files(spark, version, touched)
    kept = (old.where(has_key).join(picked.select(*keys).hint("merge"), keys, "left_anti").select(schema.names)
            .unionByName(old.where(~has_key)))
    new = mf.add_files(kept.unionByName(picked).unionByName(bare), root, keys[0], keys, parts)
    rest = listed.join(touched, "file", "left_anti").select(listed.columns)
    return mf.publish(spark, version, rest.unionByName(new), keys[0], schema, writer, epoch)
