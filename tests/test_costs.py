"""Validity-interval join, overlap check and cost comparison (J7) on hand-made rows."""

import random

from pyspark.sql import functions as F

from periodix.operators.validity import overlapping_intervals, validity_join
from periodix.plans.costs import CostParams, compare_costs
from tests.fixtures import ARCHIVE, GANDOPER, OBJECTS, TW, WORKS, ZHUFVR, frame, ts


def _rates(spark, rows):
    return spark.createDataFrame(
        [(r, ts(s), ts(f), v) for r, s, f, v in rows], "res string, start timestamp_ntz, finish timestamp_ntz, fot double")


def test_validity_join_half_open_and_long_intervals(spark):
    left = spark.createDataFrame(
        [(1, "R", ts("2024-01-01")), (2, "R", ts("2024-04-01")), (3, "R", ts("2024-03-31 23:59:59")),
         (4, "Q", ts("2024-02-01")), (5, "R", None), (6, "R", ts("2026-06-15"))],
        "id int, res string, d timestamp_ntz")
    rates = _rates(spark, [("R", "2024-01-01", "2024-04-01", 1.0),      # start inside, finish outside
                           ("R", "2024-04-01", "2027-01-01", 2.0),      # a long interval spanning years
                           ("R", None, "2024-01-01", 9.0)])             # null bound never matches
    got = {r.id: r.fot for r in validity_join(left, rates.withColumnRenamed("res", "_r"), [("res", "_r")], "d").collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 1.0, 4: None, 5: None, 6: 2.0}


def test_overlapping_rates_multiply_and_are_reported(spark):
    left = spark.createDataFrame([(1, "R", ts("2024-02-10"))], "id int, res string, d timestamp_ntz")
    rates = _rates(spark, [("R", "2024-01-01", "2024-04-01", 1.0), ("R", "2024-02-01", "2024-03-01", 2.0),
                           ("R", "2024-04-01", "2024-05-01", 3.0)])
    assert validity_join(left, rates.withColumnRenamed("res", "_r"), [("res", "_r")], "d").count() == 2
    bad = overlapping_intervals(rates, ["res"]).collect()
    assert [(r.fot) for r in bad] == [2.0]


def test_cost_comparison(spark):
    p = CostParams(own_contractor_value="OWN", main_worker_analytics="MAIN", plan_objects=("S",),
                   works_code_objects=("S",), period_start="2022-01-01 00:00:00", period_mid="2023-01-01 00:00:00",
                   period_end="2024-01-01 00:00:00", deleted_before="2022-11-01 00:00:00")
    tw = frame(spark, TW, [
        dict(work_id="w1", analytics_value="x", contragent_value="OWN", res_name="R", res_code="C", hours=2.0),
        dict(work_id="w1", analytics_value="MAIN", res_name="R", res_code="C", hours=1.0),
        dict(work_id="w1", analytics_value="y", contragent_value=None, res_name="R", res_code="C", hours=4.0),
        dict(work_id="w2", analytics_value="x", contragent_value="OWN", res_name="R", res_code="C", hours=5.0),
        dict(work_id="w3", analytics_value="x", contragent_value="OWN", res_name="R", res_code="C", hours=6.0),
    ])
    works = frame(spark, WORKS, [
        dict(work_id="w1", zhufvr_id="z1", structure_unique_code="K 1", structure_works_code="X"),
        # qualifies only by the second path: deleted, dated before the limit, code 'Kzn_Kzn_OP' -> 'Kzn_OP'
        dict(work_id="w2", zhufvr_id="z2", structure_unique_code="K 2", structure_works_code="Kzn_ OP",
             structure_is_delete=True),
        dict(work_id="w3", zhufvr_id="z3", structure_unique_code="K 3", structure_works_code="Kzn_OP",
             structure_is_delete=None),
    ])
    zh = frame(spark, ZHUFVR, [dict(link=f"z{i}", territory_value="1", zhfvr_date=ts("2022-05-10")) for i in (1, 2, 3)])
    objs = frame(spark, OBJECTS, [dict(territory_value="1", spider_name="S")])
    fot = spark.createDataFrame([("R", ts("2022-05-10"), ts("2022-06-01"), 10.0)],
                                "res string, start timestamp_ntz, finish timestamp_ntz, fot double")
    mim = spark.createDataFrame([("R", "S", ts("2022-01-01"), ts("2023-01-01"), 1.0, 2.0, 3.0)],
                                "res string, object string, start timestamp_ntz, finish timestamp_ntz, "
                                "leasing double, repair double, fuel double")
    crew = spark.createDataFrame([("C", 2.0)], "Code string, Kol_Ekip double")
    g = frame(spark, GANDOPER, [
        dict(index=1, Code="OP1", f_CodeIdent="K1", Start=ts("2022-02-01"), Fin=ts("2022-12-01"), project_type="проект",
             object="S", WorkLoadFact=1.0, Name="n1", c_act_AmLiz=7.0),
        dict(index=2, Code="Kzn_Kzn_OP", f_CodeIdent="K9", Start=ts("2022-02-01"), Fin=ts("2023-06-01"),
             project_type="проект", object="S", WorkLoadFact=1.0),
    ])
    arch = frame(spark, ARCHIVE, [
        dict(index=1, OperCode="OP1", ResCode="NT_1", project_type="проект", object="S", WorkLoadFact=3.0),
        dict(index=1, OperCode="OP1", ResCode="RS_1", project_type="проект", object="S", WorkLoadFact=4.0),
    ])
    out = {r.structure_unique_code: r for r in compare_costs(tw, works, zh, objs, fot, mim, crew, g, arch, p).collect()}
    assert set(out) == {"K1", "K2"}
    k1 = out["K1"]
    assert (k1.hours, k1.own_hours, k1.nt_hours) == (7.0, 3.0, 4.0)
    assert k1.fot_1c == 3.0 * 10.0 * 2.0 and k1.leasing_1c == 3.0 and k1.cost_1c == 60.0 + 3.0 + 6.0 + 9.0
    assert (k1.wrkld, k1.nt_wrkld, k1.own_wrkld, k1.leasing_sp, k1.cost_sp) == (7.0, 3.0, 4.0, 7.0, 7.0)
    assert k1.period == "2022" and k1.Name == "n1"
    k2 = out["K2"]
    assert k2.hours == 5.0 and k2.wrkld is None and k2.period == "между 2022 и 2023"


def _brute(rows, rates):
    """(id, value or None) of every match of [start, finish) and key."""
    out = []
    for i, key, day in rows:
        found = [v for k, a, b, v in rates if k is not None and k == key and a and b and day and a <= day < b]
        out += [(i, v) for v in found] or [(i, None)]
    return sorted(out, key=str)


def test_lookup_by_blocks_matches_brute_force(spark):
    """A key with most of the rows, equal dates, sentinels, overlaps and nulls, with blocks of four rows."""
    rng = random.Random(4)
    day = lambda n: f"{2020 + n // 360}-{n % 360 // 30 + 1:02d}-{n % 28 + 1:02d}"
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([day(77), day(rng.randrange(900)), day(rng.randrange(900)), None])) for i in range(600)]
    rates = [(rng.choice(["hot", "hot", "a", "c", None]), day(n), day(n + rng.choice([0, 1, 40, 300])), float(k)) for k, n in enumerate(rng.randrange(900) for _ in range(150))]
    rates += [("hot", "2020-01-01", "9999-12-31", 1e6), ("b", None, "9999-12-31", 2e6), ("a", "2021-01-01", None, 3e6)]
    left = spark.createDataFrame(rows, "id int, key string, d string").withColumn("d", F.col("d").cast("timestamp_ntz")).repartition(3)
    right = spark.createDataFrame(rates, "k string, start string, finish string, v double")
    right = right.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "finish")})
    want = _brute(rows, rates)
    for limit, bits in ((0, 2), (0, 10), (10**6, 2)):
        out = validity_join(left, right, [("key", "k")], "d", broadcast_intervals=limit, block_bits=bits)
        assert out.columns == ["id", "key", "d", "k", "start", "finish", "v"]
        assert sorted(((r.id, r.v) for r in out.collect()), key=str) == want
    inner = validity_join(left, right, [("key", "k")], "d", how="inner", broadcast_intervals=0, block_bits=2)
    assert sorted(((r.id, r.v) for r in inner.collect()), key=str) == [w for w in want if w[1] is not None]
    assert validity_join(left, right.where("false"), [("key", "k")], "d").count() == len(rows)


def test_a_sentinel_costs_one_copy_a_block(spark):
    """Rows met by an endless interval are a handful of copies, whatever its length: nothing is expanded by month."""
    left = spark.range(5000).select("id", F.lit("R").alias("res"), F.lit("2024-03-01").cast("timestamp_ntz").alias("d"))
    rates = spark.createDataFrame([("R", "2000-01-01", "9999-12-31", 1.0)], "_r string, start string, finish string, fot double")
    rates = rates.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "finish")})
    out = validity_join(left, rates, [("res", "_r")], "d", broadcast_intervals=0)
    assert out.where("fot = 1.0").count() == 5000
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()


def test_overlaps_of_a_key_with_most_intervals(spark):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        a = rng.randrange(20000)
        rows.append((rng.choice(["hot"] * 9 + ["x", None]), a, a + rng.choice([1, 2, 5, 30 if i % 50 else 4000]), i))
    rates = spark.createDataFrame(rows, "res string, start int, finish int, id int")
    want = []
    for key in {r[0] for r in rows}:
        reach = None
        for _, a, b, i in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3]):
            if reach is not None and a < reach:
                want.append((key, a, b))
            reach = b if reach is None else max(reach, b)
    for bits in (2, 10):
        got = overlapping_intervals(rates.repartition(5), ["res"], block_bits=bits)
        assert got.columns == rates.columns
        assert sorted(((r.res, r.start, r.finish) for r in got.collect()), key=str) == sorted(want, key=str)
