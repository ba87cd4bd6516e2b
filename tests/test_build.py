"""The full build on the smallest driver tables: every model written, checks counted."""

import os
import tempfile
from dataclasses import replace
from pathlib import Path

import pytest

from periodix.catalog import cost_params, world
from periodix.plans.build import BuildParams, Sources, build
from tests.conftest import SF_SMALL


def test_build_writes_all_models(spark):
    tmp_path = Path(tempfile.mkdtemp(prefix="periodix-build-"))  # a new scratch folder per run
    w = world(spark, SF_SMALL)
    src = Sources(**{f: getattr(w, f) for f in Sources.__dataclass_fields__})
    params = BuildParams(own_contractor_name=w.params.own_contractor_name,
                         placeholder_analytics=w.params.placeholder_analytics, costs=cost_params(w),
                         plan_unique_key=True)
    counts = build(spark, src, params, base=str(tmp_path))
    for name in ["contract_positions", "plan_by_month", "fact_by_month",
                 "plan_fact_mart", "hours_mart", "costs_mart"]:
        assert os.path.isdir(tmp_path / name), name
        assert spark.read.parquet(str(tmp_path / name)).count() > 0, name
    assert set(counts) >= {"check_fact_nz", "unique_position_key", "check_duplication_of_oper"}
    assert counts["unique_position_key"] == 0 and counts["not_null_position_key"] == 0


def _inputs(spark):
    w = world(spark, SF_SMALL)
    src = Sources(**{f: getattr(w, f) for f in Sources.__dataclass_fields__})
    return src, BuildParams(own_contractor_name=w.params.own_contractor_name, placeholder_analytics=w.params.placeholder_analytics,
                            costs=cost_params(w), plan_unique_key=True)


def test_violations_are_written_in_full(spark):
    base = tempfile.mkdtemp(prefix="periodix-build-")  # a new scratch folder per run
    src, params = _inputs(spark)
    counts = build(spark, src, params, base=base)
    assert counts["machine_rate_overlaps"] > 5  # the binding's machine rates overlap by a month
    for name, n in counts.items():
        assert spark.read.parquet(f"{base}/violations/{name}").count() == n
    mart = spark.read.parquet(f"{base}/plan_fact_mart")
    assert {"code", "start_year", "Name"} <= set(mart.columns)
    assert spark.sql("SELECT count(*) FROM plan_start").first()[0] > 0
    assert spark.read.parquet(f"{base}/calendar_adjust").count() > 0


def test_repeated_keys_stop_the_build(spark):
    src, params = _inputs(spark)
    for table, keys in (("works", "work_id"), ("zhufvr", "link"), ("gandoper", "gant_index, code")):
        rows = getattr(src, table)
        flawed = replace(src, **{table: rows.unionByName(rows.limit(400))})
        with pytest.raises(ValueError, match=keys):
            build(spark, flawed, params, base=tempfile.mkdtemp(prefix="periodix-build-"))


def test_written_columns_keep_their_order(spark):
    from periodix.sources.sinks import write_table

    df = spark.createDataFrame([(1, 2024, "x"), (2, 2025, "y")], "a int, start_year int, b string")
    back = write_table(df, tempfile.mkdtemp(prefix="periodix-sink-"), "t", partition_by=["start_year"])
    assert back.columns == ["a", "start_year", "b"] and sorted(map(tuple, back.collect())) == [(1, 2024, "x"), (2, 2025, "y")]


def test_built_tables_are_joined_where_they_lie(spark):
    """Mart enrichment and the per-operation check over built tables: nothing of the written side is shuffled."""
    from periodix.plans import checks as Q
    from periodix.plans.plan_fact import plan_fact_mart

    base = tempfile.mkdtemp(prefix="periodix-build-")  # a new scratch folder per run
    src, params = _inputs(spark)
    build(spark, src, params, base=base)
    plan, fact, mart = (spark.table(f"{name}_by_code_object") for name in ("plan_by_month", "fact_by_month", "plan_fact_mart"))
    positions = spark.read.parquet(f"{base}/contract_positions")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, written in ((plan_fact_mart(plan, fact, src.gandoper, positions), ("plan_by_month", "fact_by_month")),
                            (Q.check_oper_duplication(src.gandoper, src.archive, mart), ("plan_fact_mart",))):
            lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
            for i, line in enumerate(lines):
                if "FileScan" in line and any(f"/{name}]" in line for name in written):
                    depth = line.index("FileScan")
                    above = []  # the nodes over the scan, up to the join or aggregate that it serves
                    for up in reversed(lines[:i]):
                        at = next((k for k, ch in enumerate(up) if ch.isalpha() or ch == "*"), 0)
                        if at < depth:
                            above.append(up.strip(" :+-*()0123456789"))
                            depth = at
                            if "Join" in up:
                                break
                    assert above and not any(a.startswith("Exchange") for a in above), above
        assert mart.count() == spark.read.parquet(f"{base}/plan_fact_mart").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
