"""Scale guards on the physical plans of the registered queries: where a
window, a broadcast or a Python operator may appear at all."""

import re
from pathlib import Path

from plan_report import shape

from conftest import SF_SMALL

# A window only over tables bounded by the partition count, the sink count or
# the 25 nations; an explicit broadcast only of the per-partition offsets.
# extent_chunks: over the row groups of one task, and over one row per task.
WINDOW_ALLOWED = {"key_range_chunks", "clip_ranges", "reconcile", "exchange_report", "extent_chunks"}
# load_*: Spark itself picks a broadcast there, below its size threshold.
BROADCAST_ALLOWED = {"key_range_chunks", "load_ignore", "load_replace", "load_replace_two_keys", "extent_chunks"}
PYTHON_ALLOWED = {"remote_text_header", "extent_chunks"}


def test_plan_shapes(spark):
    from loadbay.plans import PLANS

    windows, broadcasts, python = set(), set(), set()
    for key, fn in PLANS.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        if "Window" in plan:
            windows.add(key)
        if s["broadcasts"]:
            broadcasts.add(key)
        if s["python"]:
            python.add(key)
    assert windows <= WINDOW_ALLOWED, windows - WINDOW_ALLOWED
    assert broadcasts <= BROADCAST_ALLOWED, broadcasts - BROADCAST_ALLOWED
    assert python <= PYTHON_ALLOWED, python - PYTHON_ALLOWED


def test_sources():
    root = Path(__file__).resolve().parent.parent / "loadbay"
    code = {str(f.relative_to(root)): f.read_text() for f in root.rglob("*.py")}
    uses = lambda pattern: {f for f, text in code.items() if re.search(pattern, text)}
    assert not uses(r"\.rdd\b|mapPartitions\(")
    assert not uses(r"localCheckpoint|crossJoin|toPandas|\bfrom loadbay\.llm") - {f for f in code if f.startswith("llm/")}
    assert not uses(r"localCheckpoint|crossJoin|toPandas")
    assert not uses(r"mapInPandas|applyInPandas") - {"sinks/files.py", "sources/files.py", "sources/http.py"}
