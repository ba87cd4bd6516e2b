"""Physical-plan shape: the design decisions that make the jobs scale, checked on real plans."""

import pytest

from periodix.catalog import REGISTRY
from tests.conftest import SF_SMALL


def plan_of(spark, name):
    df = REGISTRY[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["plan_month_spread", "hours_normed", "hours_mart"])
def test_no_key_partitioned_window(spark, name):
    # per-key quantities come from partial aggregates joined back, never from a window over the key's rows
    assert "Window" not in plan_of(spark, name)


@pytest.mark.parametrize("name", ["plan_month_spread_dup", "fact_month_spread"])
def test_windows_see_a_keys_months_alone(spark, name):
    # the running sum along a key's months is over rows aggregated by (key, month), so a hot key has one for each month
    lines = plan_of(spark, name).split("\n")
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    assert windows
    for i in windows:
        assert "_month" in lines[i]
        below = next(line for line in lines[i + 1:] if "Aggregate(" in line)
        assert "_month" in below.split("functions=")[0]


def test_unique_key_spread_is_narrow(spark):
    plan = plan_of(spark, "plan_month_spread")
    assert "Generate explode" in plan
    assert "SortMergeJoin" not in plan and "HashAggregate" not in plan
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_plan_repartitions_by_a_fixed_number(spark, name):
    assert "REPARTITION_BY_NUM" not in plan_of(spark, name)


def test_duplicate_key_spread_scans_its_table_twice(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a static plan shows which exchanges are reused
    try:
        plan = plan_of(spark, "plan_month_spread_dup")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 2, plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(spark, "hours_zero")
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,A))" in plan \
        or "Not(EqualTo(l_returnflag,A))" in plan


def static_plan(spark, name):
    """The plan without adaptive execution and broadcasts by size: every exchange shows where it is."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        return plan_of(spark, name).split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["plan_fact_mart", "check_grand_total", "check_oper_duplication"])
def test_months_of_the_mart_are_not_sorted_for_its_dimensions(spark, name):
    joins = [line for line in static_plan(spark, name) if "Join [code" in line and "_g_code" in line]
    assert len(joins) == 2 and all("ShuffledHashJoin" in line for line in joins), joins


def test_grand_total_adds_up_each_table_alone(spark):
    lines = static_plan(spark, "check_grand_total")
    assert sum("partial_max(_m_sp" in line for line in lines) == 1
    assert not [line for line in lines if "partial_sum" in line and "_a_ss" in line and "_m_ss" in line]


def test_hours_are_shuffled_once_for_all_dimensions(spark):
    from periodix import labels as L

    lines = static_plan(spark, "hours_mart")
    assert not [line for line in lines if f"Exchange hashpartitioning({L.COL_ENRP_TYPE}" in line]
    position = next(i for i, line in enumerate(lines) if "Join [Num_Con" in line)
    hours = next(i for i, line in enumerate(lines) if "Join [replace(structure_unique_code" in line)
    assert hours < position  # positions are joined with the operations, below the hours


@pytest.mark.parametrize("name", ["plan_month_spread_dup", "fact_month_spread"])
def test_events_stay_where_the_intervals_were_joined(spark, name):
    lines = static_plan(spark, name)
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    join = next(i for i in range(window, len(lines)) if "SortMergeJoin" in lines[i])
    assert not [line for line in lines[window:join] if "Exchange" in line]


def test_duplicate_projects_groups_by_the_code_alone(spark):
    assert "concat_ws" not in plan_of(spark, "check_duplicate_projects")


def test_months_of_the_mart_are_never_shuffled(spark):
    """Plan and fact months are laid out behind every exchange, from one row for an operation or for a key and site."""
    lines = static_plan(spark, "plan_fact_mart")
    depth = [next((k for k, ch in enumerate(line) if ch.isalpha() or ch == "*"), 0) for line in lines]
    laid_out = [i for i, line in enumerate(lines) if "Generate explode(sequence(0" in line]
    assert len(laid_out) == 2
    for i in laid_out:
        at = depth[i]
        for up in reversed(range(i)):
            if depth[up] < at:
                at = depth[up]
                assert "Exchange" not in lines[up], lines[up]


def test_the_mart_hashes_rows_of_operations(spark):
    """They are narrower than an operation's dimensions, and what is hashed must fit a task's memory."""
    joins = [line for line in static_plan(spark, "plan_fact_mart") if "Join [code" in line and "_g_code" in line]
    assert len(joins) == 2 and all("BuildLeft" in line for line in joins), joins
