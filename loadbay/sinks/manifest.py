"""Tables of immutable data files under a manifest.

A load writes new files beside the old ones and then publishes a new version:
the list of the files that now make the table, each with the first and last
value of its key.  A version is one small file whose name is its number, put in
place by one rename; it names the folder with the list (Parquet, written by
Spark).  So a reader sees the version it opened, old or new, never a mixture
and never nothing; a failed load leaves files that no version names.

A version also keeps, for every writer, the last epoch it has applied: a load
whose epoch was applied already is not repeated.

A scan with a key range opens only the files whose range it meets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = "_versions"
#: Columns of the list of files besides ``file``.
LO, HI, ROWS, NULLS = "lo", "hi", "rows", "nulls"


@dataclass(frozen=True)
class Version:
    """One published version of the table at ``root``."""

    root: str
    number: int = 0
    files: str | None = None
    key: str | None = None
    schema: str | None = None
    epochs: dict[str, int] = field(default_factory=dict)

    def applied(self, writer: str, epoch: int | None) -> bool:
        return epoch is not None and self.epochs.get(writer, -1) >= epoch


class Conflict(RuntimeError):
    """Another load published a version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS is JVM-only
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path  # noqa: SLF001


def _child(root: str, *names: str) -> str:
    return "/".join([root.rstrip("/"), *names])


def current(spark: SparkSession, root: str) -> Version:
    """The newest version; number 0 if nothing was published."""
    fs, folder, path = _fs(spark, _child(root, VERSIONS))
    if not fs.exists(folder):
        return Version(root)
    numbers = [int(n) for n in (st.getPath().getName() for st in fs.listStatus(folder)) if n.isdigit()]
    if not numbers:
        return Version(root)
    stream = fs.open(path(folder, f"{max(numbers):012d}"))
    try:
        said = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Version(root, max(numbers), said["files"], said["key"], said["schema"], said["epochs"])


def files(spark: SparkSession, version: Version) -> DataFrame:
    """file, lo, hi, rows, nulls of every file of a version."""
    return spark.read.parquet(_child(version.root, version.files))


def files_in_range(spark: SparkSession, version: Version, start: object = None, stop: object = None,
                   closed: bool = False) -> DataFrame:
    """The files that may hold keys in ``[start, stop)`` (None: open; ``closed``
    takes ``stop`` itself too).  Files of NULL keys alone meet no range."""
    out = files(spark, version)
    if start is not None:
        out = out.where(F.col(HI) >= F.lit(start))
    if stop is not None:
        out = out.where((F.col(LO) <= F.lit(stop)) if closed else (F.col(LO) < F.lit(stop)))
    return out


def read_files(spark: SparkSession, version: Version, listed: DataFrame | None = None,
               file_as: str | None = None) -> DataFrame:
    """The rows of the listed files (all of the version by default), with the
    file's name in ``file_as`` if given.  The paths pass through the driver, as
    those of any file scan do."""
    schema = T.StructType.fromJson(json.loads(version.schema))
    listed = files(spark, version) if listed is None else listed
    paths = [_child(version.root, r["file"]) for r in listed.select("file").collect()]
    if not paths:
        return spark.createDataFrame([], schema.add(file_as, "string") if file_as else schema)
    rows = spark.read.schema(schema).parquet(*paths)
    name = F.substring_index(F.col("_metadata.file_path"), "/", -3)  # data/<load>/<file>
    return rows.select("*", name.alias(file_as)) if file_as else rows


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the newest version."""
    version = current(spark, root)
    if not version.number:
        raise FileNotFoundError(f"no version of {root} was published")
    return read_files(spark, version)


def add_files(rows: DataFrame, root: str, key: str, sort: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Write rows as new data files, dealt and sorted by ``key`` (then ``sort``),
    and describe them: file, lo, hi, rows, nulls.  Reading their keys back costs
    one column."""
    spark = rows.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    order = [F.col(f"`{c}`") for c in (key, *[c for c in sort if c != key])]
    # The hash spreads rows of one key, or of none, over several files.
    ranges = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])]
    dealt = rows.repartitionByRange(parts, *ranges) if parts else rows.repartitionByRange(*ranges)
    dealt.sortWithinPartitions(*order).write.parquet(_child(root, folder))
    k = F.col(f"`{key}`")
    name = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name"))
    return (spark.read.schema(rows.schema).parquet(_child(root, folder)).groupBy(name.alias("file"))
            .agg(F.min(k).alias(LO), F.max(k).alias(HI), F.count(F.lit(1)).alias(ROWS),
                 F.count_if(k.isNull()).alias(NULLS)))


def publish(spark: SparkSession, before: Version, listed: DataFrame, key: str, schema: T.StructType,
            writer: str = "load", epoch: int | None = None) -> Version:
    """Make ``listed`` (file, lo, hi, rows, nulls) the next version after
    ``before``; ``Conflict`` if another load was first."""
    name = f"{VERSIONS}/files-{uuid.uuid4().hex}"
    listed.select("file", LO, HI, ROWS, NULLS).write.parquet(_child(before.root, name))
    epochs = {**before.epochs, **({writer: epoch} if epoch is not None else {})}
    after = Version(before.root, before.number + 1, name, key, schema.json(), epochs)
    fs, folder, path = _fs(spark, _child(before.root, VERSIONS))
    place = path(folder, f"{after.number:012d}")
    draft = path(folder, f".{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(json.dumps({"files": name, "key": key, "schema": after.schema, "epochs": epochs}).encode())
    out.close()
    # A rename onto a file fails in HDFS; where it would replace the file, the
    # check before it does.
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise Conflict(f"version {after.number} of {before.root} is there already")
    return after


def remove_unused(spark: SparkSession, root: str) -> int:
    """Delete what the newest version does not name (data of older versions and
    of failed loads); only when no reader holds an older version.  Returns the
    number of deleted data folders and files."""
    version = current(spark, root)
    fs, base, path = _fs(spark, root)
    used = {r["file"] for r in files(spark, version).select("file").collect()}
    gone = 0
    for load in (fs.listStatus(path(base, "data")) if fs.exists(path(base, "data")) else []):
        for st in fs.listStatus(load.getPath()):
            name = f"data/{load.getPath().getName()}/{st.getPath().getName()}"
            if name.endswith(".parquet") and name not in used:
                gone += bool(fs.delete(st.getPath(), False))
    for st in fs.listStatus(path(base, VERSIONS)):
        name = st.getPath().getName()
        if name not in (f"{version.number:012d}", version.files.split("/")[-1]):
            fs.delete(st.getPath(), True)
    return gone
