"""Names of shards, tables and paths (R12 name lists, K8 routing).

These expand a *name pattern* into a list of names on the driver; the list is
as long as the pattern says (tables, partitions), never as long as the data.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadbay.functions.text import ColumnOrName, _c

def _counted(low: int, high: int, step: int, width: int, base: str = "d") -> list[str]:
    """Numbers low..high as text, zero-padded to ``width`` (0: as they are)."""
    return [format(k, f"0{width}{base}" if width else base) for k in range(low, high + 1, step)]


def _product(pieces: list[list[str]]) -> list[str]:
    return ["".join(choice) for choice in itertools.product(*pieces)]


def expand_shards(tables: str) -> list[str]:
    """``"t_[00-15],u"`` -> ``["t_00", ..., "t_15", "u"]``.

    Reversed bounds are swapped; numbers are zero-padded to the width of the
    lower bound when it starts with ``0``; items without a range stay as they
    are.
    """
    names: list[str] = []
    for item in map(str.strip, tables.split(",")):
        name, opened, rest = item.partition("[")
        bounds, closed, tail = rest.partition("]")
        low, _, high = bounds.partition("-")
        ranged = (opened and closed and all(x.isascii() and x.isdigit() for x in (low, high))
                  and name.isascii() and name.replace("_", "a").isalnum())
        if not ranged:
            names.append(item)
            continue
        low, high = sorted((low, high), key=int)
        width = len(low) if low.startswith("0") else 0
        names += _product([[name], _counted(int(low), int(high), 1, width), [tail.strip()]])
    return names


def _brace_choices(body: str) -> list[str] | None:
    """The values of ``a..b`` or ``a..b..step``; None when it is no range."""
    bounds = body.split("..")
    if len(bounds) not in (2, 3) or not all(x.isascii() and x.isalnum() for x in bounds):
        return None
    low, high, step = bounds[0], bounds[1], bounds[2] if len(bounds) == 3 else "1"
    if not step.isdigit():
        return None
    for base, radix, lead in (("x", 16, "0x"), ("d", 10, "")):
        if not all(x.lower().startswith(lead) for x in (low, high)):
            continue
        digits = [x[len(lead):] for x in (low, high)]
        try:
            first, last = (int(x, radix) for x in digits)
        except ValueError:
            continue
        width = len(digits[0]) if len(digits[0]) == len(digits[1]) else 0
        return _counted(first, last, int(step), width, base)
    if len(low) == len(high) == 1 and low.isalpha() and high.isalpha():
        return [chr(k) for k in range(ord(low), ord(high) + 1, int(step))]
    return None


def expand_pattern(text: str) -> list[str]:
    """Brace lists: ``x{1..10..2}``, ``{a..g}``, ``{0x01..0xff}``; several
    braces give their cartesian product; equal-width bounds keep the width."""
    pieces: list[list[str]] = []
    for part in re.split(r"(\{[^{}]*\})", text):
        choices = _brace_choices(part[1:-1]) if part.startswith("{") else None
        pieces.append([part] if choices is None else choices)
    return _product(pieces)


def work_date_macros(text: str, work_date: _dt.date | str | None = None) -> str:
    """Replace ``{yyyymmdd}`` (the work date, default yesterday) and
    ``{v_month_first}`` (first day of its month) in a table or path name."""
    if work_date is None:
        work_date = _dt.date.today() - _dt.timedelta(days=1)
    if isinstance(work_date, str):
        work_date = _dt.datetime.strptime(work_date, "%Y%m%d").date()
    return (text.replace("{yyyymmdd}", work_date.strftime("%Y%m%d"))
                .replace("{v_month_first}", work_date.replace(day=1).strftime("%Y%m%d")))


def route_shard_name(col: ColumnOrName) -> Column:
    """K8: target of a sharded source table: ``s_`` + lower-cased name without
    its trailing digits and underscores (``Orders_07`` -> ``s_orders``)."""
    return F.concat(F.lit("s_"), F.lower(F.regexp_replace(_c(col), r"[0-9_]+$", "")))
