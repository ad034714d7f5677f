"""Plan guards: no cartesian products or nested-loop joins in any registered
batch query; the tick scan is pruned and the window aggregate hash-based."""

import re

import pytest

import __spark_entry__ as E
from tickrisk.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_tick_scan_pruned_and_hash_aggregated(spark):
    plan = _plan(Q.QUERIES["log_return"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(len(s.split(",")) <= 4 for s in schemas)
    assert "HashAggregate" in plan and "SortAggregate" not in plan
