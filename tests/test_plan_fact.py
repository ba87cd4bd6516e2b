"""J1-J5 on hand-made edge rows."""

import pytest

from periodix import labels as L
from periodix.operators.plan_start import plan_start
from periodix.operators.positions import contract_positions
from periodix.plans.plan_fact import fact_by_month, plan_by_month, plan_fact_mart
from tests.fixtures import ARCHIVE, GANDOPER, VDC, frame, ts

P = L.PROJECT


def test_plan_start_filters_and_days(spark):  # J2
    g = frame(spark, GANDOPER, [
        dict(index=1, Code="a", DurPlanD=None, Start=ts("2024-01-01"), Fin=ts("2024-03-10"), VolPlan=1.0, project_type=P),
        dict(index=2, Code="b", DurPlanD=2.0, Start=ts("2024-01-01"), Fin=ts("2024-03-10"), VolPlan=1.0, project_type=P),
        dict(index=3, Code="c", DurPlanD=0.25, Start=ts("2024-01-01"), Fin=ts("2024-03-10"), VolPlan=1.0, project_type=P),
        dict(index=4, Code="d", Start=None, Fin=ts("2024-03-10"), VolPlan=1.0, project_type=P),
        dict(index=5, Code="e", Start=ts("2024-01-01"), Fin=ts("2024-03-10"), VolPlan=None, project_type=P),
        dict(index=6, Code="f", Start=ts("2024-01-01"), Fin=None, VolPlan=1.0, project_type=P),
        dict(index=7, Code="g", Start=ts("2024-01-01"), Fin=ts("2024-03-10"), VolPlan=1.0, project_type=L.SNAPSHOT_NZ),
    ])
    got = {r.code: r.start_date for r in plan_start(g).collect()}
    assert got == {"a": ts("2024-03-10"), "b": ts("2024-03-08"), "c": ts("2024-03-09 18:00:00")}


def _ops(spark):
    return frame(spark, GANDOPER, [
        # 2024-01-31 .. 2024-03-02 (31 days before), one row per key
        dict(index=1, Code="a", DurPlanD=31.0, Start=ts("2024-01-01"), Fin=ts("2024-03-02"), VolPlan=1.0,
             project_type=P, object="S1", c_pln_SMRSsI=1000.0, c_pln_SMRSpI=None, c_pln_Materl=2.5, c_pln_UslGpd=10.0),
        dict(index=2, Code="b", DurPlanD=None, Start=ts("2024-01-01"), Fin=ts("2024-05-15"), VolPlan=1.0,
             project_type=P, object="S2", c_pln_SMRSsI=3.5, c_pln_Materl=2.5),
    ])


def test_plan_unique_and_general_paths_agree(spark):  # J3
    g = _ops(spark)
    fast = sorted(tuple(r) for r in plan_by_month(g, unique_key=True).collect())
    general = sorted(tuple(r) for r in plan_by_month(g).collect())
    assert fast == general
    b = [r for r in plan_by_month(g, unique_key=True).collect() if r.code == "b"]
    assert len(b) == 1 and b[0].start_month == 5
    # zero-length single part: weight 1; 3.5 + 0 -> SMRFull 4 (ties to even), costs -2.5 -> -2
    assert (b[0].SMRFull, b[0].ZATRATY, b[0].smr_sp) == (4.0, -2.0, None)


def test_plan_measures_are_weighted(spark):  # J3
    rows = {(r.start_month): r for r in plan_by_month(_ops(spark), unique_key=True).where("code = 'a'").collect()}
    assert set(rows) == {1, 2, 3}
    total = sum(r.smr_ss for r in rows.values())
    assert total == pytest.approx(1000.0)
    assert rows[1].smr_ss == pytest.approx(1000.0 / 31)   # one day of 31
    assert all(r.smr_type == L.PLAN and r.object == "S1" for r in rows.values())


def test_plan_duplicate_keys_share_weights(spark):  # J3, duplicate keys
    g = frame(spark, GANDOPER, [
        dict(index=1, Code="k", DurPlanD=None, Start=ts("2024-01-01"), Fin=ts("2024-01-20"), VolPlan=1.0,
             project_type=P, object="S", c_pln_SMRSsI=100.0),
        dict(index=1, Code="k", DurPlanD=10.0, Start=ts("2024-01-01"), Fin=ts("2024-02-05"), VolPlan=1.0,
             project_type=P, object="T", c_pln_SMRSsI=50.0),
    ])
    rows = plan_by_month(g).collect()
    # both raw rows are spread by the key's common weights, and each raw row's total is conserved
    assert {(r.object, r.start_month) for r in rows} == {("S", 1), ("S", 2), ("T", 1), ("T", 2)}
    per_object = {}
    for r in rows:
        per_object[r.object] = per_object.get(r.object, 0.0) + r.smr_ss
    assert per_object == pytest.approx({"S": 100.0, "T": 50.0})
    share = {(r.object, r.start_month): r.smr_ss for r in rows}
    assert share[("S", 2)] / 100.0 == pytest.approx(share[("T", 2)] / 50.0)


def test_fact_sums_all_rows_of_key_and_site(spark):  # J4
    a = frame(spark, ARCHIVE, [
        dict(index=1, OperCode="op", ResCode=None, Start=ts("2024-01-10"), Fin=ts("2024-02-10"), project_type=P,
             object="S", c_aac_SMRSsI=310.0),
        # resource row: no month parts of its own, but its measures join back
        dict(index=1, OperCode="op", ResCode="NT_1", Start=ts("2023-01-01"), Fin=ts("2023-01-02"), project_type=P,
             object="S", c_aac_SMRSsI=310.0, c_aac_Materl=31.0),
        # null start: parts with null weight, dropped at the end
        dict(index=2, OperCode="op2", ResCode=None, Start=None, Fin=ts("2024-02-10"), project_type=P,
             object="S", c_aac_SMRSsI=5.0),
    ])
    rows = {r.start_month: r for r in fact_by_month(a).collect()}
    assert set(rows) == {1, 2}
    assert rows[1].smr_ss == pytest.approx(620.0 * 22 / 31)   # Jan 10..Feb 1 is 22 of 31 days
    assert rows[1].ZATRATY == round(-31.0 * 22 / 31)
    assert all(r.smr_type == L.FACT for r in rows.values())


def test_positions_label_skips_nulls(spark):  # J1
    v = frame(spark, VDC, [
        {L.COL_CIPHER: "C1", L.COL_WORK_NAME: "Work", "object": "S"},
        {L.COL_CIPHER: None, L.COL_WORK_NAME: "Work", "object": "S"},
        {L.COL_CIPHER: "C3", L.COL_WORK_NAME: None, "object": None},
    ])
    got = [(r[L.COL_POSITION], r.unique_test) for r in contract_positions(v).collect()]
    assert got == [("C1    Work", "C1    S"), ("    Work", "    S"), ("C3    ", "C3    ")]


def test_mart_dimensions(spark):  # J5
    reals = [None, "Собственные силы", "Собственными силами", "Субподряд", "Силами субподрядных организаций", "другое"]
    rows = []
    for i, real in enumerate(reals):
        rows.append(dict(index=i, Code=f"c{i}", DurPlanD=None, Start=ts("2024-09-01"), Fin=ts(f"2024-{9 + i % 2:02d}-15"),
                         VolPlan=1.0, project_type=P, object="S", c_pln_SMRSsI=1.0, Real=real,
                         SNT_Knstr=L.EARTHWORK if i == 0 else "x", Num_Con="C1" if i == 1 else "none"))
    g = frame(spark, GANDOPER, rows)
    v = contract_positions(frame(spark, VDC, [{L.COL_CIPHER: "C1", L.COL_WORK_NAME: "W", "object": "S",
                                               L.COL_CONTRACT_SMR: 5.0}]))
    a = frame(spark, ARCHIVE, [])
    mart = plan_fact_mart(plan_by_month(g, unique_key=True), fact_by_month(a), g, v)
    got = {r.code: r for r in mart.collect()}
    assert [got[f"c{i}"][L.COL_DELIVERY_MODE] for i in range(6)] == [
        None, L.OWN_FORCES_LABEL, L.OWN_FORCES_LABEL, L.SUBCONTRACT_LABEL, L.SUBCONTRACT_LABEL, None]
    assert got["c0"].s_month == "09" and got["c1"].s_month == "10"
    assert got["c0"][L.COL_STRUCTURE] == L.EARTHWORK and got["c2"][L.COL_STRUCTURE] == L.OTHER_WORKS
    assert got["c1"][L.COL_POSITION] == "C1    W" and got["c2"][L.COL_POSITION] is None


@pytest.mark.parametrize("unique_key", [True, False])
def test_mart_of_operations_equals_mart_of_months(spark, unique_key):  # J5
    """Months laid out behind the joins: codes and keys come twice, at several sites, and parts of them are missing."""
    ops = [dict(index=i, Code=f"c{i % 5}" if i else None, DurPlanD=None if i % 4 == 0 else 17.5 * i, Start=ts("2024-01-01"), Fin=ts(f"2024-0{1 + i % 9}-15"),
                VolPlan=None if i == 7 else 1.0, project_type=P, object=f"S{i % 2}" if i != 3 else None, c_pln_SMRSsI=None if i == 2 else 10.5 * i,
                c_pln_SMRSpI=None if i % 3 else 0.3 * i, c_pln_Materl=1.7 * i, c_pln_UslGpd=0.1 * i, Real="Субподряд", SNT_Knstr=L.PAVEMENT, Name=f"n{i}",
                Num_Con="C1" if i % 2 else None) for i in range(12)]
    done = [dict(index=i % 4, OperCode=f"c{i % 3}", ResCode="R" if i % 3 == 1 else None, Start=ts(f"2023-1{i % 3}-07") if i % 8 else None,
                 Fin=ts(f"2024-0{1 + i % 7}-01 12:00") if i % 5 else None, project_type=P, object=f"S{i % 2}", c_aac_SMRSsI=100.0 + i, c_aac_Materl=0.7 * i) for i in range(40)]
    done += [dict(index=9, OperCode="c1", Start=ts("2024-03-01"), Fin=ts("2024-03-01"), project_type=P, object="S1", c_aac_SMRSpI=5.0),
             dict(index=8, OperCode="c1", Start=None, Fin=ts("2024-03-01"), project_type=P, object="S1", c_aac_SMRSpI=5.0)]
    g, a = frame(spark, GANDOPER, ops), frame(spark, ARCHIVE, done)
    v = contract_positions(frame(spark, VDC, [{L.COL_CIPHER: "C1", L.COL_WORK_NAME: w, "object": "S1", L.COL_CONTRACT_SMR: 5.0} for w in ("W1", "W2")]))
    marts = [plan_fact_mart(plan_by_month(g, unique_key, laid_out=months), fact_by_month(a, laid_out=months), g, v) for months in (True, False)]
    assert marts[0].schema == marts[1].schema
    months, operations = (sorted(map(repr, m.collect())) for m in marts)
    assert months == operations and {L.PLAN, L.FACT} == {r.smr_type for r in marts[1].select("smr_type").distinct().collect()}
    assert any("smr_sp=5.0" in r for r in operations)


def test_collapsed_duplicate_keys_differ_by_rounding_alone():
    """One row per (raw row, month) against one per (part, raw row): totals differ by at most half a unit for each row."""
    import duckdb

    from oracle.spread_sql import plan_ctes, recursive_views
    from tests.conftest import SF_SMALL

    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    totals = {}
    for collapse in (False, True):
        sql = recursive_views("plan_lines") + "," + plan_ctes("plan_lines", collapse)
        totals[collapse] = {r[:2]: r[2:] for r in con.execute(
            sql + 'SELECT gant_index, code, count(*), sum("ZATRATY"), sum("PRIBYL"), sum(smr_ss) FROM plan_months GROUP BY ALL').fetchall()}
    assert totals[True].keys() == totals[False].keys() and sum(r[0] for r in totals[True].values()) <= sum(r[0] for r in totals[False].values())
    for key, (n, costs, profit, own) in totals[True].items():
        n2, costs2, profit2, own2 = totals[False][key]
        assert abs(costs - costs2) <= 0.5 * (n + n2) and abs(profit - profit2) <= 0.5 * (n + n2)
        assert abs(own - own2) <= 1e-6 * max(1, abs(own))
