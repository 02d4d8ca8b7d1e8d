"""Native operators have no Python in their plans or their modules."""

import re
from pathlib import Path

import pytest

import loadbay.llm
from loadbay.llm import queries

SF_SMALL = "/root/testdata/sf0.001"
MODULES = ("quotes", "mixing", "pii", "quality_rules")


@pytest.mark.parametrize("name", MODULES)
def test_modules_are_native(name):
    code = (Path(loadbay.llm.__file__).parent / f"{name}.py").read_text()
    assert not re.search(r"mapIn|applyIn|\\budf\\b|pandas|pyarrow|numpy|\\.rdd", code)


@pytest.mark.parametrize("name", ["op1_quote_links", "op3_systematic_mix", "op7_personal_data", "op13_quality_rules"])
def test_plans_are_native(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Arrow|Pandas|Python|ExistingRDD|CartesianProduct|NestedLoop", plan)
