"""Date and time text rules.

Parsing is strict and time-zone free: the text is matched against the exact
shape of each pattern and the parts go through ``try_make_timestamp_ntz``, so
an impossible date (month 13, 29 Feb of a common year) gives NULL instead of
a failed task, and the result never depends on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadbay.functions.text import ColumnOrName, _c, java_trim

# How each source dialect prints its date/time columns.
# Spark type -> pattern; types not listed print as plain text.
DATE_TEXT_DIALECTS = {
    # datetime/timestamp -> "yyyy-MM-dd HH:mm:ss"; date stays "yyyy-MM-dd"
    "mysql": {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": None},
    "hive": {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": None},
    "sqlserver": {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": None},
    # date and timestamp -> "yyyy-MM-dd HH:mm:ss" (a pure date gets 00:00:00)
    "oracle": {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd HH:mm:ss"},
    "postgres": {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd HH:mm:ss"},
}


def dates_to_text(df: DataFrame, dialect: str = "mysql") -> DataFrame:
    """P10: every column to text, date/time columns with the dialect's pattern.

    Sub-second digits are dropped, as the source drivers print them.
    """
    return df.select([dialect_text(F.col(f"`{f.name}`"), f.dataType, dialect).alias(f.name)
                      for f in df.schema.fields])


def format_dates(df: DataFrame, dialect: str = "mysql") -> DataFrame:
    """P10 on the date/time columns only; other columns keep their type."""
    return df.select([
        dialect_text(F.col(f"`{f.name}`"), f.dataType, dialect).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def dialect_text(col: Column, data_type: T.DataType, dialect: str) -> Column:
    """P10 for one column of a known type."""
    rules = DATE_TEXT_DIALECTS[dialect.lower()]
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)) and rules["timestamp"]:
        return format_ntz(col, rules["timestamp"])
    if isinstance(data_type, T.DateType) and rules["date"]:
        return format_ntz(col.cast("timestamp_ntz"), rules["date"])
    return col.cast("string")


# A pattern's pieces: quoted text, a run of one letter, or other characters.
_RUNS = re.compile(r"'([^']*)'|([A-Za-z])\2*|[^A-Za-z']+")


def format_ntz(col: ColumnOrName, pattern: str) -> Column:
    """A timestamp printed by ``pattern`` from its own text, so a wall time
    inside a DST gap prints as it is.  Patterns with letters other than
    y M d H h m s S a go to Spark's ``date_format``, which uses the session
    zone."""
    t = _c(col)
    text = t.cast("string")  # yyyy-MM-dd HH:mm:ss[.ffffff]
    if "yyyy-MM-dd HH:mm:ss".startswith(pattern):
        return F.substring(text, 1, len(pattern))
    hour = F.substring(text, 12, 2).cast("int")
    known = {
        "yyyy": F.substring(text, 1, 4), "yy": F.substring(text, 3, 2), "MM": F.substring(text, 6, 2),
        "dd": F.substring(text, 9, 2), "HH": F.substring(text, 12, 2), "mm": F.substring(text, 15, 2),
        "ss": F.substring(text, 18, 2), "MMM": F.monthname(t.cast("date")),
        "hh": F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, "0"),
        "a": F.when(hour < 12, "AM").otherwise("PM"),
    }
    pieces = []
    for m in _RUNS.finditer(pattern):
        run = m[0]
        if m[2] is None:
            pieces.append(F.lit(run if m[1] is None else m[1] or "'"))
        elif run in known:
            pieces.append(known[run])
        elif m[2] == "S":
            pieces.append(F.substring(F.rpad(F.substring(text, 21, 9), len(run), "0"), 1, len(run)))
        else:
            return F.date_format(t, pattern)
    return F.concat(*pieces)


# The trial formats of the JDBC loader, in trial order.
LONG_DATE_FORMATS = ("yyyyMMdd HH:mm:ss", "yyyy-MM-dd HH:mm:ss")
SHORT_DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd", "HH:mm:ss")

# pattern -> (exact shape, 1-based start of year, month, day, hour, minute,
# second in the text; None = not in the pattern).  The shape fixes every
# position, so the parts are plain substrings.
_SHAPES = {
    "yyyyMMdd HH:mm:ss": (r"\A\d{8} \d{2}:[0-5]\d:[0-5]\d\z", (1, 5, 7, 10, 13, 16)),
    "yyyy-MM-dd HH:mm:ss": (r"\A\d{4}-\d{2}-\d{2} \d{2}:[0-5]\d:[0-5]\d\z", (1, 6, 9, 12, 15, 18)),
    "yyyyMMdd": (r"\A\d{8}\z", (1, 5, 7, None, None, None)),
    "yyyy-MM-dd": (r"\A\d{4}-\d{2}-\d{2}\z", (1, 6, 9, None, None, None)),
    "HH:mm:ss": (r"\A\d{2}:[0-5]\d:[0-5]\d\z", (None, None, None, 1, 4, 7)),
}
_DEFAULT_PART = (1970, 1, 1, 0, 0, 0)


def parse_with(col: ColumnOrName, pattern: str) -> Column:
    """Text -> TIMESTAMP_NTZ by one pattern; no match or impossible -> NULL.

    ``RR`` is a two-digit year of 1950 to 2049.  Patterns with letters that
    are not in ``_PART_SHAPES`` go to Spark's own parser, which uses the
    session zone."""
    c = _c(col)
    shape = _SHAPES.get(pattern)
    if shape is None:
        return _parse_parts(c, pattern)

    regex, starts = shape

    def part(k: int) -> Column:
        pos = starts[k]
        if pos is None:
            return F.lit(_DEFAULT_PART[k])
        width = 4 if k == 0 else 2
        return F.substring(c, pos, width).cast("int")

    made = F.try_make_timestamp_ntz(*[part(k) for k in range(6)])
    return F.when(c.rlike(regex), made)


# Pattern run -> shape of its text.
_PART_SHAPES = {"yyyy": r"\d{4}", "yy": r"\d{2}", "RR": r"\d{2}", "MM": r"\d{2}", "MMM": "[A-Za-z]{3}",
                "MMMM": "[A-Za-z]{3,9}", "dd": r"\d{2}", "HH": r"\d{2}", "hh": r"\d{2}", "mm": r"[0-5]\d",
                "ss": r"[0-5]\d", "a": "[AaPp][Mm]"}
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
           "october", "november", "december")


def _parse_parts(c: Column, pattern: str) -> Column:
    """The parts of a pattern's shape, put together without a time zone."""
    regex, runs = "", []
    for m in _RUNS.finditer(pattern):
        run = m[0]
        if m[2] is None:
            regex += re.escape(run if m[1] is None else m[1] or "'")
            continue
        shape = rf"\d{{1,{len(run)}}}" if m[2] == "S" else _PART_SHAPES.get(run)
        if shape is None or run in runs:
            return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
        regex += f"({shape})"
        runs.append("S" if m[2] == "S" else run)
    regex = rf"\A{regex}\z"
    part = {run: F.regexp_extract(c, regex, k) for k, run in enumerate(runs, 1)}

    def number(run: str) -> Column:
        return part[run].try_cast("int")

    year, month, hour = F.lit(1970), F.lit(1), F.lit(0)
    if "yyyy" in part:
        year = number("yyyy")
    elif "yy" in part:
        year = number("yy") + 2000
    elif "RR" in part:
        year = number("RR") + F.when(number("RR") < 50, 2000).otherwise(1900)
    if "MM" in part:
        month = number("MM")
    for run, names in (("MMM", [n[:3] for n in _MONTHS]), ("MMMM", list(_MONTHS))):
        if run in part:
            month = F.array_position(F.array(*[F.lit(n) for n in names]), F.lower(part[run])).cast("int")
    if "HH" in part:
        hour = number("HH")
    elif "hh" in part:
        hour = F.when(number("hh").between(1, 12), number("hh") % 12)
        if "a" in part:
            hour = hour + F.when(F.lower(part["a"]) == "pm", 12).otherwise(0)
    second = part.get("ss", F.lit("0"))
    if "S" in part:
        second = F.concat(second, F.lit("."), F.substring(F.rpad(part["S"], 6, "0"), 1, 6))
    made = F.try_make_timestamp_ntz(
        year, month, number("dd") if "dd" in part else F.lit(1), hour,
        number("mm") if "mm" in part else F.lit(0), second.try_cast("decimal(8,6)"))
    return F.when(c.rlike(regex), made)


def _canonical(t: Column, formats: tuple[str, ...]) -> Column:
    """The first format whose exact shape ``t`` has, rewritten to the one
    canonical shape ``yyyyMMdd HH:mm:ss`` (the shapes exclude each other, so
    the first matching shape is also the only format that can parse it)."""
    out = None
    for fmt in formats:
        regex = _SHAPES[fmt][0]
        if fmt == "yyyyMMdd HH:mm:ss":
            text = t
        elif fmt == "yyyy-MM-dd HH:mm:ss":
            text = F.translate(t, "-", "")
        elif fmt == "yyyyMMdd":
            text = F.concat(t, F.lit(" 00:00:00"))
        elif fmt == "yyyy-MM-dd":
            text = F.concat(F.translate(t, "-", ""), F.lit(" 00:00:00"))
        else:  # HH:mm:ss
            text = F.concat(F.lit("19700101 "), t)
        out = (F.when(t.rlike(regex), text) if out is None
               else out.when(t.rlike(regex), text))
    return out


def _from_canonical(c: Column) -> Column:
    parts = [F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2),
             F.substring(c, 10, 2), F.substring(c, 13, 2), F.substring(c, 16, 2)]
    return F.try_make_timestamp_ntz(*[p.cast("int") for p in parts])


def parse_dates(col: ColumnOrName, masks: tuple[str, ...] | None = None) -> Column:
    """Text -> timestamp by trial formats.

    Without ``masks``: the *untrimmed* length decides the group (> 11:
    date-time formats, else date or time formats); the trimmed text (control
    characters and blanks cut, as Java's ``trim``) is tried against each
    format in order; none fits -> NULL.  With ``masks`` the given patterns
    are tried in order instead.
    """
    c = _c(col)
    t = java_trim(c)
    if masks:
        return F.coalesce(*[parse_with(t, m) for m in masks])
    canon = F.when(F.length(c) > 11, _canonical(t, LONG_DATE_FORMATS)).otherwise(
        _canonical(t, SHORT_DATE_FORMATS))
    return _from_canonical(canon)


def reformat_date(col: ColumnOrName, src: str, dst: str) -> Column:
    """Date text in ``src`` pattern -> text in ``dst`` pattern.

    Empty or NULL input gives ``""``; text that does not parse gives ``""``.
    """
    c = _c(col)
    if not src or not dst:
        return F.lit("")
    parsed = parse_with(c, src)
    out = format_ntz(parsed, dst)
    return F.when(c.isNull() | (c == F.lit("")), F.lit("")).otherwise(F.coalesce(out, F.lit("")))


def timestamp_to_date(col: ColumnOrName, src: str, dst: str) -> Column:
    """P12 (second form): like :func:`reformat_date`, keeping only the part
    of the result before the first space."""
    r = reformat_date(col, src, dst)
    return F.substring_index(r, " ", 1)
