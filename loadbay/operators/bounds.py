"""Exact key-range bounds without sorting the key.

``key_range_select`` gives the rows of ``ranges.key_range_chunks`` for keys that
are whole numbers at heart (integers, dates, timestamps with a zone, booleans,
decimals of up to 18 digits).  The bounds are keys at known ranks.  One pass finds the
smallest and largest key and the counts; then the range is divided into
histogram bins, and each further pass divides the bins that hold a wanted rank
again, until a bin is one key.  A pass is a scan of the key column and an
aggregate of at most ``2 * n * 2**BITS`` groups with partial aggregation, so
what is shuffled depends on ``n`` and the number of tasks, not on the rows, and
a key that a third of the rows share is one number per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the key that one pass settles.
BITS = 8


def _as_number(key: Column, kind: T.DataType) -> Column:
    """The key as a long in the same order."""
    if isinstance(kind, T.IntegralType):
        return key.cast("long")
    if isinstance(kind, T.BooleanType):
        return key.cast("int").cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (key.cast(f"decimal({kind.precision}, {kind.scale})") * (10 ** kind.scale)).cast("long")
    raise TypeError(f"a key of type {kind.simpleString()} has no bounds by histogram; use key_range_chunks")


def _as_key(number: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return number.cast(kind)
    if isinstance(kind, T.BooleanType):
        return number == 1
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(number)
    return (number.cast("decimal(38, 0)") / F.lit(10 ** kind.scale).cast("decimal(20, 0)")).cast(kind)


def numbers_at(numbers: DataFrame, ranks: list[int], low: int, high: int, bits: int = BITS) -> dict[int, int]:
    """The values of the long column ``k`` (none NULL, all in ``low`` to
    ``high``) at 0-based ranks, by rank."""
    spark = numbers.sparkSession
    width = (high - low).bit_length()
    if width > 63:
        raise OverflowError("the keys span more than a long")
    above = F.col("k") - F.lit(low)
    at = {r: (0, r) for r in ranks}  # rank -> bin, rank within the bin
    left = width
    while left > 0:
        step = min(bits, left)
        left -= step
        held = spark.createDataFrame(sorted({(b,) for b, _ in at.values()}), "bin long")  # 2 n rows at most
        digits = numbers.select(F.shiftright(above, left).alias("d"))
        counted = (digits.join(F.broadcast(held), F.shiftright("d", step) == F.col("bin"))
                   .groupBy("bin", "d").agg(F.count(F.lit(1)).alias("n"))
                   .groupBy("bin").agg(F.sort_array(F.collect_list(F.struct("d", "n"))).alias("parts")))
        # At most 2**bits parts a bin; the walk through them ends at the rank.
        wanted = spark.createDataFrame([(r, b, w) for r, (b, w) in at.items()], "rank long, bin long, within long")
        walk = F.aggregate(
            "parts", F.struct(F.col("within").alias("left"), F.lit(None).cast("long").alias("d"),
                              F.lit(None).cast("long").alias("within")),
            lambda s, x: F.when(s["d"].isNotNull(), s).when(
                s["left"] < x["n"], F.struct(s["left"].alias("left"), x["d"].alias("d"), s["left"].alias("within"))).otherwise(
                F.struct((s["left"] - x["n"]).alias("left"), s["d"].alias("d"), s["within"].alias("within"))))
        found = wanted.join(counted, "bin").select("rank", walk.alias("at"))
        at = {r["rank"]: (r["at"]["d"], r["at"]["within"]) for r in found.collect()}
    return {r: low + b for r, (b, _) in at.items()}


def key_range_select(df: DataFrame, key: str, n: int = 200, bits: int = BITS) -> DataFrame:
    """``(chunk, lo, hi, rows)`` for NTILE(n) over ``key``, NULL keys first,
    as ``key_range_chunks`` gives it."""
    kind = df.schema[key].dataType
    numbers = df.select(_as_number(F.col(f"`{key}`"), kind).alias("k"))
    total, known, low, high = numbers.agg(
        F.count(F.lit(1)), F.count("k"), F.min("k"), F.max("k")).first()
    nulls = total - known
    size, more = divmod(total, n)
    chunks, start = [], 0
    for i in range(min(n, total)):
        rows = size + (i < more)
        # Ranks among the keys that are not NULL; none where the chunk has only NULLs.
        first, last = max(start - nulls, 0), start + rows - 1 - nulls
        chunks.append((i, first if last >= 0 else None, last if last >= 0 else None, rows))
        start += rows
    ranks = sorted({r for c in chunks for r in c[1:3] if r is not None})
    value = numbers_at(numbers.where("k is not null"), ranks, low, high, bits) if ranks else {}
    out = df.sparkSession.createDataFrame(
        [(i, value.get(a), value.get(b), rows) for i, a, b, rows in chunks], "chunk int, lo long, hi long, rows long")
    return out.select("chunk", _as_key(F.col("lo"), kind).alias("lo"), _as_key(F.col("hi"), kind).alias("hi"), "rows")
