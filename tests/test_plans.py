"""
through one partition.  A single-partition exchange is allowed only above a global
aggregate's partial results, a bounded top-k, or the per-bucket offset tables of the
surrogate-key operator (at most 256 rows)."""

import re

from tests.conftest import SF001
ALLOWED_CHILD = (
    re.compile(r"HashAggregate\(keys=\[\]"),             # partial results of a global aggregate
    re.compile(r"ObjectHashAggregate\(keys=\[\]"),
    re.compile(r"HashAggregate\(keys=\[_(bucket|range)#"),  # offset table of assign_keys
)


def _single_partition_children(plan: str) -> list[str]:
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            out.append(lines[i + 1].strip().lstrip(":+- *()0123456789"))
    return out


def check_plan(name, df):
    """Used by tests/test_oracle.py for every registered query."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for child in _single_partition_children(plan):
        assert any(p.search(child) for p in ALLOWED_CHILD), f"{name}: single partition over {child}"
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_second_run_upsert_has_no_single_partition_work(spark):
    """Re-loading the same members (nothing new) must not plan a one-partition window."""
    from salesmart.operators import dims as D
    from salesmart.plans.queries import staged
    members = D.customer_members(staged(spark, SF001, "customers"))
    first = D.load_dim_customer(members, None).table
    first = spark.createDataFrame(first.collect(), first.schema)
    again = D.load_dim_customer(members, first)
    plan = again.table._jdf.queryExecution().executedPlan().toString()
    for child in _single_partition_children(plan):
        assert any(p.search(child) for p in ALLOWED_CHILD), child
    assert "BroadcastNestedLoopJoin" not in plan
    assert again.counts().filter("state = 'unchanged'").first().n == 150
