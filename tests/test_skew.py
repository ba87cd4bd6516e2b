"""join_per_key and existence_flags against plain joins, and how Spark can split a hot key in them."""

import pytest
from pyspark.sql import functions as F

from periodix.operators.skew import existence_flags, join_per_key

#: Two layouts: many small partitions split where skewed, and one partition for everything.
LAYOUTS = [{"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1"},
           {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}]


@pytest.fixture(params=LAYOUTS, ids=["split", "whole"])
def layout(spark, request):
    before = {k: spark.conf.get(k) for k in request.param}
    for k, v in request.param.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_join_per_key_equals_plain_join(spark, layout):
    rows = spark.range(0, 600).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("k"),
        F.col("id").alias("v"))
    # two per-key rows for each key
    per_key = rows.select("k").distinct().withColumn("slot", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .select("k", "slot", (F.col("k") * 10 + F.col("slot")).alias("w"))
    plain = sorted(tuple(r) for r in rows.join(per_key, "k").select("k", "v", "slot", "w").collect())
    assert sorted(tuple(r) for r in join_per_key(rows, per_key, ["k"]).select("k", "v", "slot", "w").collect()) == plain


def test_both_sides_are_shuffled_for_the_join_alone(spark):
    """An aggregate on the key does not fix the join's partitioning, so adaptive execution may split either side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
        joined = join_per_key(rows, rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"])
        plan = joined._jdf.queryExecution().sparkPlan().toString() + joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin [coalesce"):]
    assert join.count("Exchange hashpartitioning(coalesce") == 2 and "ENSURE_REQUIREMENTS" in join


def test_join_per_key_null_key_is_one_group(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    per_key = spark.createDataFrame([(None, "null group"), ("a", "a group")], "k string, w string")
    out = join_per_key(rows, per_key, ["k"]).select("k", "v", "w").collect()
    got = sorted((tuple(r) for r in out), key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert got == [(None, 1, "null group"), (None, 2, "null group"), ("a", 3, "a group")]


def test_existence_flags_matches_semi_and_anti(spark, layout):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, v int")
    keyset = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "k string")
    got = {r.v: r._exists for r in existence_flags(rows, keyset, ["k"]).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: True}   # a null key never matches


def test_branch_b_of_the_hours_in_any_layout(spark, layout):
    """One group with a third of the norm rows, most of them equal: totals and the one cut do not depend on the layout."""
    from periodix import labels as L
    from periodix.plans import hours as H
    from tests.fixtures import NW, OBJECTS, TW, WORKS, ZHUFVR, frame, ts

    works = [f"w{i}" for i in range(60)]
    ctx = H.work_context(
        frame(spark, WORKS, [dict(work_id=w, zhufvr_id="z") for w in works]),
        frame(spark, ZHUFVR, [dict(link="z", territory_value="1", zhfvr_date=ts("2024-01-01"), delete_flag=False, is_done=True)]),
        frame(spark, OBJECTS, [dict(territory_value="1", spider_name="S")]))
    row = lambda w, fact: dict(work_id=w, analytics_value="a", res_spider_code=L.MAIN_WORKER_CODE, res_spider_name="n",
                               fact_workload=fact, norm_workload=1.0, nt_res=None)
    norm = [row("w0", 2.0)] * 180 + [row("w0", 1.0)] * 20 + [row(w, 3.0) for w in works[1:] for _ in range(7)]
    tw = frame(spark, TW, [dict(work_id=w, analytics_value="a", hours=10.0) for w in works])
    out = H.hours_normed(tw, frame(spark, NW, norm).repartition(7), ctx, ()).select("work_id", L.COL_FACT_HOURS).collect()
    hot = sorted(r[1] for r in out if r[0] == "w0")
    assert hot == sorted([2.0 - (380.0 - 10.0)] + [2.0] * 179 + [1.0] * 20)
    assert sorted(r[1] for r in out if r[0] == "w5") == [3.0 - (21.0 - 10.0)] + [3.0] * 6
    assert len(out) == len(norm)


def test_join_on_keys_equals_plain_join(spark, layout):
    from periodix.operators.skew import join_on_keys

    keys = [(None, "a"), (0, "a"), (0, ""), (1, None), (1, "b"), (None, None), (0, None)]
    rows = spark.createDataFrame([(*k, v) for v, k in enumerate(keys * 40)], "k long, c string, v int")
    per_key = spark.createDataFrame([(*k, w) for w, k in enumerate(keys)], "k long, c string, w int")
    plain = sorted(tuple(r) for r in rows.join(per_key, ["k", "c"]).select("v", "w").collect())
    assert sorted(tuple(r) for r in join_on_keys(rows, per_key, ["k", "c"]).select("v", "w").collect()) == plain
