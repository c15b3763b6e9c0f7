"""Regression guards on AQE final plans: scans, shuffles and joins of key queries.

Each DataFrame is executed once (collected on the JVM side) so the final plan,
after exchange reuse and runtime re-planning, is what gets checked.
"""

import re

import pytest

from __spark_entry__ import queries
from plan_report import whole_final_plan

SF = "/root/testdata/sf0.001"

# query -> (lineitem scans, max hash exchanges)
EXPECTED = {
    "sum_by_period": (1, 1),
    "grouping_sets_totals": (1, 1),
    "mining_production_by_region": (1, 3),
    "mining_production_by_mtype": (1, 3),
    "mining_production_region_pages": (1, 3),
    "mixed_grain_union": (1, 3),
    "detail_plus_total": (1, 1),
    "mtype_employment_series": (1, 3),
    "pivot_fill_zero": (1, 1),
    "computed_columns": (1, 0),
}


def final_plan(df) -> str:
    df._jdf.collectAsList()
    return whole_final_plan(df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_final_plan_shape(spark, name):
    scans, max_hash = EXPECTED[name]
    plan = final_plan(queries()[name](spark, SF))
    assert len(re.findall(r"FileScan parquet \[[^\]]*\] .*lineitem\.parquet", plan)) == scans, plan
    assert plan.count("Exchange hashpartitioning") <= max_hash, plan
    assert "SortMergeJoin" not in plan


def test_no_unpartitioned_window_over_data(spark):
    """Windows without a partition key only over one-row-per-period series or partition counts."""
    for name in ("mining_production_by_region", "mining_employment_by_county", "growth_global_order"):
        plan = final_plan(queries()[name](spark, SF))
        for line in plan.splitlines():
            if line.strip().startswith(("+- Window [", "Window [")) and "windowspecdefinition(" in line:
                spec = line.split("windowspecdefinition(", 1)[1]
                # first argument of the spec is a partition key unless the spec starts with an ordering
                assert not re.match(r"\s*[\w.]+ ASC", spec) or "_pid ASC" in spec, line


def test_whole_final_plan_keeps_what_follows_a_cached_relation(spark):
    cached = spark.range(100).groupBy("id").count().persist()
    plan = final_plan(cached.join(spark.range(50), "id").groupBy("count").agg({"id": "max"}))
    cached.unpersist()
    assert "InMemoryTableScan" in plan and plan.count("Range (") >= 2


# Pivots without a declared column list: the table reads the checkpoint, the scan ran once before it.
@pytest.mark.parametrize("name, table", [("state_year_panel", "orders"), ("generation_monthly_wide", "lineitem"), ("generation_annual_wide", "lineitem"),
                                         ("combined_panel", "lineitem"), ("combined_panel", "orders")])
def test_pivots_read_their_checkpoint(spark, name, table):
    plan = final_plan(queries()[name](spark, SF))
    assert "Scan ExistingRDD" in plan and f"{table}.parquet" not in plan
