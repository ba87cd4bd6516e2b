"""J6 hours reconciliation on hand-made rows: each branch rule, the group-first adjustment, labels."""

from decimal import Decimal

import pytest

from periodix import labels as L
from periodix.plans import hours as H
from tests.fixtures import NW, OBJECTS, TW, WORKS, ZHUFVR, frame, ts

OWN = "Own LLC"
PH = ("PH1", "PH2")


@pytest.fixture(scope="module")
def ctx(spark):
    works = frame(spark, WORKS, [dict(work_id=w, zhufvr_id=f"z{w}", type_work_name="t", enrp_type="O",
                                      structure_unique_code=f"K {w}") for w in ["w1", "w2", "w3", "w4", "w5"]])
    zh = frame(spark, ZHUFVR, [
        dict(link="zw1", territory_value="1", zhfvr_date=ts("2024-01-05"), delete_flag=False, is_done=True),
        dict(link="zw2", territory_value="1", zhfvr_date=ts("2024-01-05"), delete_flag=False, is_done=True),
        dict(link="zw3", territory_value="1", zhfvr_date=ts("2024-01-05"), delete_flag=True, is_done=True),   # deleted
        dict(link="zw4", territory_value="1", zhfvr_date=ts("2024-01-05"), delete_flag=None, is_done=True),   # unknown
        dict(link="zw5", territory_value="9", zhfvr_date=ts("2024-01-05"), delete_flag=False, is_done=True),  # unmapped
    ])
    objs = frame(spark, OBJECTS, [dict(territory_value="1", spider_name="SITE"), dict(territory_value="9")])
    return H.work_context(works, zh, objs)


def _tw(spark):
    return frame(spark, TW, [
        dict(work_id="w1", analytics_value="a", contragent_name=OWN, res_code="r", hours=10.0),       # A: no norm
        dict(work_id="w1", analytics_value="b", contragent_name="Other", hours=5.0),                 # B and C
        dict(work_id="w1", analytics_value="PH1", analytics_name="(НТ) x", hours=7.0),               # placeholder: A
        dict(work_id="w2", analytics_value="m", analytics_name="plain", hours=8.0),                  # B: Mont excess
        dict(work_id="w3", analytics_value="a", hours=1.0),                                          # deleted journal
        dict(work_id="w4", analytics_value="a", hours=1.0),                                          # null flag
        dict(work_id="w5", analytics_value="a", hours=1.0),                                          # unmapped site
    ])


def _nw(spark):
    return frame(spark, NW, [
        dict(work_id="w1", analytics_value="b", res_spider_code="X", fact_workload=4.0, norm_workload=4.0, nt_res=True),
        dict(work_id="w1", analytics_value="b", res_spider_code="Y", fact_workload=0.0, norm_workload=1.0),
        dict(work_id="w1", analytics_value="PH1", res_spider_code="X", fact_workload=3.0, norm_workload=0.0, nt_res=False),
        # group fact total 6 + 6 = 12 > 8 + 1: the first row by code desc is 'Mont' -> 6 - (12 - 8) = 2, once
        dict(work_id="w2", analytics_value="m", res_spider_code="Mont", fact_workload=6.0, norm_workload=5.0),
        dict(work_id="w2", analytics_value="m", res_spider_code="Mont", fact_workload=6.0, norm_workload=5.0),
    ])


def test_unnormed_branch(spark, ctx):
    rows = H.hours_unnormed(_tw(spark), _nw(spark), ctx, OWN, PH).collect()
    got = {r.work_id + "/" + str(float(r[L.COL_FACT_HOURS])): r for r in rows}
    assert set(got) == {"w1/10.0", "w1/7.0"}
    assert got["w1/10.0"][L.COL_RESOURCE] == L.OWN_RESOURCE and got["w1/7.0"][L.COL_RESOURCE] == L.HIRED_RESOURCE
    assert all(r[L.COL_NORMED] is False and r.object == "SITE" for r in rows)


def test_zero_branch(spark, ctx):
    rows = H.hours_zero(_tw(spark), _nw(spark), ctx, OWN, PH).collect()
    assert [(r.work_id, r[L.COL_FACT_HOURS], r[L.COL_RESOURCE], r[L.COL_NORMED]) for r in rows] == [
        ("w1", 5.0, L.HIRED_RESOURCE, True)]


def test_normed_branch_rules(spark, ctx):
    rows = H.hours_normed(_tw(spark), _nw(spark), ctx, PH).collect()
    by = sorted((r.work_id, r[L.COL_RESOURCE_CODE], r[L.COL_FACT_HOURS], r[L.COL_RESOURCE]) for r in rows)
    assert by == [
        ("w1", "X", 0.0, L.OWN_RESOURCE),        # placeholder analytics -> 0 hours
        ("w1", "X", 4.0, L.HIRED_RESOURCE),
        ("w2", "Mont", 2.0, None),               # exactly one copy of the duplicated first row is adjusted
        ("w2", "Mont", 6.0, None),
    ]


def test_null_code_sorts_first(spark, ctx):  # T4
    tw = frame(spark, TW, [dict(work_id="w1", analytics_value="n", hours=1.0)])
    nw = frame(spark, NW, [
        dict(work_id="w1", analytics_value="n", res_spider_code=None, fact_workload=3.0, norm_workload=1.0),
        dict(work_id="w1", analytics_value="n", res_spider_code="Mont", fact_workload=3.0, norm_workload=1.0),
    ])
    # the null code is first, so the 'Mont' row is not adjusted although the group exceeds the hours
    got = sorted(r[L.COL_FACT_HOURS] for r in H.hours_normed(tw, nw, ctx, PH).collect())
    assert got == [3.0, 3.0]


def test_ownership_labels(spark, ctx):
    tw = frame(spark, TW, [
        dict(work_id="w1", analytics_value="1", contragent_name=OWN, hours=1.0),
        dict(work_id="w1", analytics_value="2", contragent_name="X", analytics_name="(НТ) y", hours=2.0),
        dict(work_id="w1", analytics_value="3", analytics_name="(НТ) y", hours=3.0),
        dict(work_id="w1", analytics_value="4", analytics_name="y", hours=4.0),
        dict(work_id="w1", analytics_value="5", hours=0.0),
    ])
    nw = frame(spark, NW, [])
    got = {r[L.COL_FACT_HOURS]: (r[L.COL_RESOURCE], r[L.COL_NORM_HOURS])
           for r in H.hours_unnormed(tw, nw, ctx, OWN, PH).collect()}
    assert got == {1.0: (L.OWN_RESOURCE, 1.0), 2.0: (L.HIRED_RESOURCE, 2.0), 3.0: (L.HIRED_RESOURCE, 3.0),
                   4.0: (L.OWN_RESOURCE, 4.0), 0.0: (None, 0.0)}


def test_null_analytics_group_is_kept(spark, ctx):
    # a window partitioned by (work, analytics) keeps a null analytics value as its own group
    tw = frame(spark, TW, [dict(work_id="w1", analytics_value=None, hours=1.0)])
    nw = frame(spark, NW, [
        dict(work_id="w1", analytics_value=None, res_spider_code="Mont", fact_workload=2.0, norm_workload=1.0),
        dict(work_id="w1", analytics_value=None, res_spider_code="A", fact_workload=2.0, norm_workload=1.0),
    ])
    got = sorted(r[L.COL_FACT_HOURS] for r in H.hours_normed(tw, nw, ctx, PH).collect())
    # raw hours do not join on a null analytics value, so the excess rule cannot fire
    assert got == [2.0, 2.0]


def test_mart_enrichment(spark):
    from periodix.operators.positions import contract_positions
    from tests.fixtures import GANDOPER, VDC

    works = frame(spark, WORKS, [dict(work_id="w1", zhufvr_id="z1", enrp_type="O", structure_unique_code="K 1")])
    zh = frame(spark, ZHUFVR, [dict(link="z1", territory_value="1", zhfvr_date=ts("2024-05-06"), work_shift_name="day",
                                    delete_flag=False, is_done=True)])
    objs = frame(spark, OBJECTS, [dict(territory_value="1", spider_name="SITE")])
    tw = frame(spark, TW, [dict(work_id="w1", analytics_value="a", res_code="Mont", hours=10.0)])
    nw = frame(spark, NW, [dict(work_id="w1", analytics_value="b", res_spider_code="X", fact_workload=3.0,
                                norm_workload=0.0, nt_res=False),
                           dict(work_id="w1", analytics_value="c", res_spider_code="Y", fact_workload=3.0,
                                norm_workload=2.0, nt_res=True)])
    g = frame(spark, GANDOPER, [dict(Code="op", f_CodeIdent="K1", object="SITE", project_type=L.PROJECT,
                                     SNT_Knstr=L.PAVEMENT, SNT_KnstrE="element", Num_Con="C1")])
    pos = contract_positions(frame(spark, VDC, [{L.COL_CIPHER: "C1", L.COL_WORK_NAME: "Work", "object": "SITE"}]))
    key_res = spark.createDataFrame([("O", "Mont")], "f_opertype string, rescode string")
    rows = H.reconcile_hours(tw, nw, works, zh, objs, g, pos, key_res, OWN, PH).collect()
    got = {r[L.COL_RESOURCE_CODE]: r for r in rows}
    assert set(got) == {"Mont", "X", "Y"}
    assert got["Mont"][L.COL_DEVIATION] == 0.0 and got["Mont"][L.COL_KEY_RESOURCE] is True
    assert got["X"][L.COL_DEVIATION] is None                 # norm 0: no deviation (guarded division)
    assert got["Y"][L.COL_DEVIATION] == 50.0 and got["Y"][L.COL_KEY_RESOURCE] is False
    r = got["Y"]
    assert (r[L.COL_STRUCTURE], r[L.COL_STRUCTURE_ELEMENT], r[L.COL_POSITION]) == (L.PAVEMENT, "element", "C1    Work")
    assert (r[L.COL_DATE], r[L.COL_SHIFT], r[L.COL_YEAR], r[L.COL_MONTH]) == (ts("2024-05-06"), "day", 2024, 5)


def test_sums_of_fractional_hours_are_exact(spark, ctx):
    """Three times 0.4 is not more than 0.2 + 1; as doubles it would be, and the rule would fire."""
    tw = frame(spark, TW, [dict(work_id="w1", analytics_value="q", hours=0.2), dict(work_id="w2", analytics_value="q", hours="0.1999")])
    nw = frame(spark, NW, [dict(work_id=w, analytics_value="q", res_spider_code="Mont", res_spider_name=n, fact_workload=0.4, norm_workload=1.0)
                           for w in ("w1", "w2") for n in "abc"])
    out = H.hours_normed(tw, nw, ctx, PH)
    got = sorted((r.work_id, r[L.COL_FACT_HOURS]) for r in out.collect())
    assert got == [("w1", Decimal("0.4"))] * 3 + [("w2", Decimal("-0.6001"))] + [("w2", Decimal("0.4"))] * 2
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types[L.COL_FACT_HOURS] == types[L.COL_NORM_HOURS] == "decimal(18,4)"


def test_copies_of_a_first_row_give_up_the_excess_once(spark, ctx):
    tw = frame(spark, TW, [dict(work_id="w1", analytics_value="q", hours=5)])
    nw = frame(spark, NW, [dict(work_id="w1", analytics_value="q", res_spider_code="Mont", fact_workload=3, norm_workload=1)] * 40).repartition(7)
    got = sorted(r[L.COL_FACT_HOURS] for r in H.hours_normed(tw, nw, ctx, PH).collect())
    assert got == [3 - (120 - 5)] + [3] * 39


def test_norm_rows_are_summed_once(spark):
    """The joined norm rows are written once; the sums over them and the rows themselves come from that table."""
    from periodix.catalog import REGISTRY
    from tests.conftest import SF_SMALL

    for name, scans in (("hours_normed", 0), ("hours_mart", 2)):
        df = REGISTRY[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("partial_sum(fact_workload") == 1
        assert plan.count("lineitem.parquet") == scans, (name, plan.count("lineitem.parquet"))
