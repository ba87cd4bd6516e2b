"""Data-quality checks: a clean set gives no rows, one planted violation gives it back."""

from periodix import labels as L
from periodix.operators.positions import contract_positions
from periodix.plans import checks as Q
from tests.fixtures import ARCHIVE, GANDOPER, NW, TW, VDC, frame


def snap(**kw):
    base = dict(object="S", nz_year="2024", nz_month="Март", Code="c1")
    base.update(kw)
    return base


def test_fact_nz_and_exception(spark):
    clean = frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_NZ, s_act_CC_SMRFull=0.0)])
    assert Q.check_fact_nz(clean).count() == 0
    bad = frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_NZ, s_act_CC_SMRFull=5.0),
                                  snap(project_type=L.SNAPSHOT_NZ, object="T", s_act_CC_SMRFull=5.0)])
    assert Q.check_fact_nz(bad).count() == 2
    assert [r.object for r in Q.check_fact_nz(bad, ("S", "2024", "Март")).collect()] == ["T"]


def test_plan_ovnz(spark):
    assert Q.check_plan_ovnz(frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_OVNZ, s_pln_CC_SMRFull=0.0)])).count() == 0
    r = Q.check_plan_ovnz(frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_OVNZ, s_pln_CC_SMRFull=1.0)])).collect()
    assert r[0].status == L.STATUS_PLAN_IN_OVNZ


def test_duplicate_projects(spark):
    rows = [snap(project_type=L.SNAPSHOT_NZ), snap(project_type=L.SNAPSHOT_NZ, Code="c2")]
    assert Q.check_duplicate_projects(frame(spark, GANDOPER, rows)).count() == 0
    rows.append(snap(project_type=L.SNAPSHOT_NZ, Code="c2"))
    assert Q.check_duplicate_projects(frame(spark, GANDOPER, rows)).first().status == L.STATUS_DUPLICATE


def test_hours_total(spark):
    tw = frame(spark, TW, [dict(work_id="w", analytics_value="a", hours=100.0)])
    ok = frame(spark, NW, [dict(work_id="w", analytics_value="a", fact_workload=100.0)])
    assert Q.check_hours_total(tw, ok).count() == 0
    bad = frame(spark, NW, [dict(work_id="w", analytics_value="a", fact_workload=100.5)])
    assert Q.check_hours_total(tw, bad).first().delta_hours == 0.5


def _mart(spark, plan_total, fact_total):
    return spark.createDataFrame(
        [("c1", "S", L.PLAN, plan_total, 0.0), ("c1", "S", L.FACT, fact_total, 0.0)],
        "code string, object string, smr_type string, smr_ss double, smr_sp double")


def test_oper_duplication_and_grand_total(spark):
    g = frame(spark, GANDOPER, [dict(Code="c1", object="S", project_type=L.PROJECT, c_pln_SMRSsI=100.0,
                                     c_pln_SMRSpI=0.0)])
    a = frame(spark, ARCHIVE, [dict(OperCode="c1", object="S", project_type=L.PROJECT, c_aac_SMRSsI=50.0,
                                    c_aac_SMRSpI=0.0)])
    assert Q.check_oper_duplication(g, a, _mart(spark, 100.0, 50.0)).count() == 0
    assert [r["count"] for r in Q.check_oper_duplication(g, a, _mart(spark, 300.0, 50.0)).collect()] == [1]
    assert [r["count"] for r in Q.check_oper_duplication(g, a, _mart(spark, 300.0, 60.0)).collect()] == [1]  # union
    assert Q.check_grand_total(g, a, _mart(spark, 100.0, 50.0)).count() == 0
    r = Q.check_grand_total(g, a, _mart(spark, 30100.0, 50.0)).first()
    assert (r.fin_total_smr, r.raw_total) == (30150.0, 150.0)
    # as in the reference, a side whose values are all null makes the total null: no verdict
    g_null = frame(spark, GANDOPER, [dict(Code="c1", object="S", project_type=L.PROJECT, c_pln_SMRSsI=100.0)])
    assert Q.check_grand_total(g_null, a, _mart(spark, 30100.0, 50.0)).count() == 0


def test_cost_components(spark):
    g = frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_NZ, s_act_CC_SMRSsI=20000.0, s_pln_CC_SMRSsI=50000.0)])
    cost = spark.createDataFrame(
        [("S", "2024", "Март", L.SNAPSHOT_NZ, "SMRSsI", 20000.0, 90000.0)],
        "object string, nz_year string, nz_month string, project_type string, Code string, "
        "f_act_Total double, f_pln_Total double")
    assert Q.check_cost_components(g, cost).count() == 0          # fact agrees
    cost2 = cost.withColumn("f_act_Total", cost.f_act_Total * 3)
    assert Q.check_cost_components(g, cost2).first().status == L.STATUS_ERROR
    assert Q.check_cost_components(g, cost2, excluded_object="S").count() == 0


def test_contract_total(spark):
    g = frame(spark, GANDOPER, [dict(object="S", project_type=L.PROJECT, s_pln_CC_SMRFull=105.0),
                                dict(object="T", project_type=L.PROJECT, s_pln_CC_SMRFull=100.0)])
    v = frame(spark, VDC, [{"object": "S", L.COL_CONTRACT_SMR: 100.0}, {"object": "T", L.COL_CONTRACT_SMR: 50.0}])
    rows = Q.check_contract_total(g, v).collect()
    assert [(r.object, r["%_delta"]) for r in rows] == [("T", 100.0)]


def test_position_checks(spark):
    v = frame(spark, VDC, [{L.COL_CIPHER: "C1", "object": "S"}, {L.COL_CIPHER: "C2", "object": "S"}])
    assert Q.check_position_unique(contract_positions(v)).count() == 0
    assert Q.check_position_not_null(contract_positions(v)).count() == 0
    v2 = frame(spark, VDC, [{L.COL_CIPHER: "C1", "object": "S"}, {L.COL_CIPHER: "C1", "object": "S"},
                            {L.COL_CIPHER: None, "object": "S"}])
    assert Q.check_position_unique(contract_positions(v2)).first().n_records == 2
    assert Q.check_position_not_null(contract_positions(v2)).count() == 1


def test_check_report(spark):
    bad = frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_NZ, object=f"S{i}", s_act_CC_SMRFull=1.0)
                                  for i in range(8)])
    clean = frame(spark, GANDOPER, [snap(project_type=L.SNAPSHOT_OVNZ, s_pln_CC_SMRFull=0.0)])
    report = Q.check_report({"fact_nz": Q.check_fact_nz(bad), "plan_ovnz": Q.check_plan_ovnz(clean)}, sample=3)
    assert report[0]["check"] == "fact_nz" and report[0]["violations"] == 8 and len(report[0]["sample"]) == 3
    assert report[1] == {"check": "plan_ovnz", "violations": 0, "sample": []}


def test_duplicate_projects_null_and_empty_codes(spark):
    """A null code counts as an empty one, as in the reference's concatenation without nulls; null periods are periods."""
    row = lambda code, year: dict(project_type="p", object="o", nz_year=year, nz_month="m", Code=code)
    rows = [row(None, "1"), row("", "1"), row(None, "2"), row("a", "3"), row("a", "4"), row("b", None), row("b", None)]
    out = Q.check_duplicate_projects(frame(spark, GANDOPER, rows)).collect()
    assert sorted(r.nz_year or "" for r in out) == ["", "1"]
