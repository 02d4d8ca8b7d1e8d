"""Text files of one prefix in a folder that other loads share.

The lines are written to a hidden folder inside the shared one first.  Only when
that job has succeeded are files of the prefix cleared and the new ones moved in
under their names, so a failed load leaves the folder as it was.  Listing, clearing
and naming are metadata calls on the driver, one per file of the load.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame

from loadbay.sinks.files import DEL_MODES, WRITE_MODES, write_delimited


def to_clear(names: Iterable[str], new: Iterable[str], prefix: str, policy: int | str) -> set[str]:
    """Which of a folder's ``names`` go before files called ``new`` come in.

    ``policy`` is a ``del_mode`` (0 and 2: files of the same names; 1: these are an
    error; 3: ``prefix`` and ``prefix-*``, whatever their suffix; 4: all) or a
    ``write_mode`` (truncate: all names that start with the prefix; nonconflict:
    these are an error; append: none)."""
    names, new = set(names), set(new)
    same, starting = names & new, {n for n in names if n.startswith(prefix)}
    refused = {1: same, "nonconflict": starting}.get(policy, set())
    if refused:
        raise FileExistsError(f"{sorted(refused)[:5]} are there already")
    numbered = re.compile(re.escape(prefix) + r"(-.*|\..*)?")
    return {0: same, 2: same, 3: {n for n in names if numbered.fullmatch(n)}, 4: names,
            "truncate": starting}.get(policy, set())


def names_for(suffixes: list[str], prefix: str, taken: Iterable[str] = ()) -> list[str]:
    """``prefix`` for one file, ``prefix-0 ..`` for several, suffixes kept.  Among
    ``taken`` names the numbers go on behind the largest one there."""
    stems = [m for m in (re.fullmatch(re.escape(prefix) + r"(?:-([0-9]+))?(?:\..*)?", n) for n in taken) if m]
    if len(suffixes) == 1 and not stems:
        return [prefix + suffixes[0]]
    first = 1 + max((int(m[1]) for m in stems if m[1]), default=-1)
    return [f"{prefix}-{first + i}{s}" for i, s in enumerate(suffixes)]


def write_shared(df: DataFrame, folder: str, prefix: str, del_mode: int | None = None,
                 write_mode: str | None = None, **text) -> list[str]:
    """Delimited text (the options of ``write_delimited``) as files of ``prefix``
    in ``folder``; returns their names.  ``write_mode`` goes before ``del_mode``,
    whose default is 3.  A table without rows gives one empty file."""
    if write_mode is not None:
        policy: int | str = write_mode.lower()
        if policy not in WRITE_MODES:
            raise ValueError(f"unknown write_mode {write_mode!r}")
    else:
        policy = 3 if del_mode is None else del_mode
        if policy not in DEL_MODES:
            raise ValueError(f"unknown del_mode {del_mode!r}")
    if not prefix or "/" in prefix or prefix.startswith(("_", ".")):
        raise ValueError(f"{prefix!r} is no prefix of data files")
    sc = df.sparkSession.sparkContext
    path_of = sc._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001 - Hadoop FS is JVM-only
    root = path_of(folder)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())  # noqa: SLF001

    def listed(path) -> list[str]:
        found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in found if not n.startswith(("_", ".")))

    if policy == "nonconflict":
        to_clear(listed(root), [], prefix, policy)  # refuse before any work
    staging = path_of(root, f"_loading-{uuid.uuid4().hex}")
    try:
        write_delimited(df, staging.toString(), del_mode=1, **text)
        parts = listed(staging)
        there = listed(root)
        suffixes = [p[p.find("."):] if "." in p else "" for p in parts]
        new = names_for(suffixes, prefix, there if policy == "append" else ())
        for name in sorted(to_clear(there, new, prefix, policy)):
            fs.delete(path_of(root, name), True)
        for part, name in zip(parts, new):
            if not fs.rename(path_of(staging, part), path_of(root, name)):
                raise OSError(f"{name} could not be moved into {folder}")
    finally:
        fs.delete(staging, True)
    return new
