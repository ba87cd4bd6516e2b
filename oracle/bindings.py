"""The binding of ``periodix.sources.bindings`` written as DuckDB views (CTEs).

Each oracle query starts with ``with_views(...)`` naming the reference tables it reads.
"""

from __future__ import annotations

from periodix import labels as L
from periodix.sources.bindings import BindingParams

P = BindingParams()


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_MONTHS = "[" + ", ".join(_q(m) for m in L.RUS_MONTHS) + "]"
_OP_CODE = ("CASE WHEN {p} = '1-URGENT' THEN concat('Kzn_OP-', CAST({k} AS VARCHAR)) "
            "ELSE concat('OP-', CAST({k} AS VARCHAR)) END")


def _costs(prefix: str, mapping: dict[str, str]) -> str:
    return ",\n        ".join(f"{mapping.get(p, 'CAST(NULL AS DOUBLE)')} AS {prefix}{p}" for p in L.COST_PARTS)


VIEWS: dict[str, str] = {}

VIEWS["orders_x"] = """
    SELECT o.*, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

VIEWS["lineitem_x"] = """
    SELECT l.*, ox.o_orderdate, ox.o_orderpriority, ox.n_name
    FROM lineitem l JOIN orders_x ox ON l.l_orderkey = ox.o_orderkey
"""

VIEWS["gandoper_project"] = f"""
    SELECT
        o_orderkey AS "index",
        {_OP_CODE.format(p='o_orderpriority', k='o_orderkey')} AS "Code",
        concat('K', CAST(o_orderkey AS VARCHAR)) AS "f_CodeIdent",
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 1000.0 END AS "DurPlanD",
        o_orderdate AS "Start",
        o_orderdate AS "Fin",
        o_totalprice AS "VolPlan",
        {_q(L.PROJECT)} AS project_type,
        n_name AS "object",
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'SR_10' WHEN o_orderpriority = '2-HIGH' THEN 'SR_20'
             ELSE 'STD' END AS "Calen",
        CAST(NULL AS VARCHAR) AS nz_year,
        CAST(NULL AS VARCHAR) AS nz_month,
        o_totalprice AS "c_pln_SMRSsI",
        CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice * 0.1::DOUBLE END AS "c_pln_SMRSpI",
        {_costs('c_pln_', {'Materl': 'o_totalprice * 0.4::DOUBLE', 'OplGpd': 'o_totalprice * 0.2::DOUBLE',
                           'St_Mex': "CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 0.05::DOUBLE END"})},
        o_totalprice * 0.03::DOUBLE AS "c_pln_UslGpd",
        o_totalprice * 0.01::DOUBLE AS "c_act_AmLiz",
        o_totalprice * 0.02::DOUBLE AS "c_act_RepMiM",
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 0.03::DOUBLE END AS "c_act_FuelMiM",
        CAST(NULL AS DOUBLE) AS "c_act_FnOpTr",
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS "s_act_CC_SMRFull",
        o_totalprice AS "s_pln_CC_SMRFull",
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS "s_act_CC_SMRSsI",
        CAST(NULL AS DOUBLE) AS "s_act_CC_SMRSpI",
        o_totalprice AS "s_pln_CC_SMRSsI",
        o_totalprice * 0.1::DOUBLE AS "s_pln_CC_SMRSpI",
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 1000.0 END AS "WorkLoadFact",
        concat('Operation ', CAST(o_orderkey AS VARCHAR)) AS "Name",
        c_name AS "Ispol",
        c_mktsegment AS "IspolUch",
        CASE c_mktsegment WHEN 'BUILDING' THEN 'Собственные силы' WHEN 'AUTOMOBILE' THEN 'Собственными силами'
             WHEN 'MACHINERY' THEN 'Субподряд' WHEN 'HOUSEHOLD' THEN 'Силами субподрядных организаций'
             ELSE c_mktsegment END AS "Real",
        CASE o_orderpriority WHEN '1-URGENT' THEN {_q(L.EARTHWORK)} WHEN '2-HIGH' THEN {_q(L.PAVEMENT)}
             ELSE o_orderpriority END AS "SNT_Knstr",
        o_orderstatus AS "SNT_KnstrE",
        o_orderpriority AS "SNT_TypeKnstrE",
        n_name AS "SNT_Obj",
        concat('CP-', CAST(o_custkey AS VARCHAR)) AS "Num_Con"
    FROM orders_x
"""

VIEWS["gandoper_snapshots"] = f"""
    SELECT
        l_orderkey AS "index",
        {_OP_CODE.format(p='o_orderpriority', k='l_orderkey')} AS "Code",
        concat('K', CAST(l_orderkey AS VARCHAR)) AS "f_CodeIdent",
        l_quantity AS "DurPlanD",
        o_orderdate AS "Start",
        l_shipdate AS "Fin",
        l_quantity AS "VolPlan",
        CASE WHEN l_linestatus = 'F' THEN {_q(L.SNAPSHOT_NZ)} ELSE {_q(L.SNAPSHOT_OVNZ)} END AS project_type,
        n_name AS "object",
        CAST(year(l_shipdate) AS VARCHAR) AS nz_year,
        {_MONTHS}[month(l_shipdate)] AS nz_month,
        CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0.0 END AS "s_act_CC_SMRFull",
        CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0.0 END AS "s_pln_CC_SMRFull",
        l_extendedprice * l_discount AS "s_act_CC_SMRSsI",
        l_extendedprice * l_tax AS "s_act_CC_SMRSpI",
        l_extendedprice AS "s_pln_CC_SMRSsI",
        CAST(NULL AS DOUBLE) AS "s_pln_CC_SMRSpI"
    FROM lineitem_x
"""

VIEWS["raw_spider__gandoper"] = """
    SELECT * FROM gandoper_project
    UNION ALL BY NAME
    SELECT * FROM gandoper_snapshots
"""

VIEWS["plan_lines"] = f"""
    SELECT
        l_orderkey AS "index",
        concat('LN-', CAST(l_linenumber AS VARCHAR)) AS "Code",
        l_quantity AS "DurPlanD",
        l_shipdate AS "Start",
        l_shipdate AS "Fin",
        l_quantity AS "VolPlan",
        {_q(L.PROJECT)} AS project_type,
        concat('SITE-', l_returnflag) AS "object",
        'STD' AS "Calen",
        l_extendedprice AS "c_pln_SMRSsI",
        CASE WHEN l_tax > 0 THEN l_extendedprice * l_tax END AS "c_pln_SMRSpI",
        l_extendedprice * l_discount AS "c_pln_UslGpd",
        {_costs('c_pln_', {'Materl': 'l_extendedprice * 0.4::DOUBLE'})}
    FROM lineitem
"""

VIEWS["raw_spider__archive"] = f"""
    SELECT
        l_orderkey AS "index",
        {_OP_CODE.format(p='o_orderpriority', k='l_orderkey')} AS "OperCode",
        CASE WHEN l_returnflag = 'N' THEN NULL
             WHEN l_returnflag = 'R' THEN concat('NT_', CAST(l_suppkey AS VARCHAR))
             ELSE concat('RS_', CAST(l_suppkey AS VARCHAR)) END AS "ResCode",
        o_orderdate AS "Start",
        l_shipdate AS "Fin",
        l_quantity AS "Vol",
        {_q(L.PROJECT)} AS project_type,
        n_name AS "object",
        l_extendedprice AS "c_aac_SMRSsI",
        CASE WHEN l_tax > 0 THEN l_extendedprice * l_tax END AS "c_aac_SMRSpI",
        l_extendedprice * l_discount AS "c_aac_UslGpd",
        {_costs('c_aac_', {'Materl': 'l_extendedprice * 0.4::DOUBLE', 'FnOpTr': 'l_quantity * 10.0::DOUBLE'})},
        l_quantity AS "WorkLoadFact"
    FROM lineitem_x
"""

VIEWS["raw_spider__cost"] = f"""
    SELECT
        n_name AS "object",
        CAST(year(l_shipdate) AS VARCHAR) AS nz_year,
        {_MONTHS}[month(l_shipdate)] AS nz_month,
        CASE WHEN l_linestatus = 'F' THEN {_q(L.SNAPSHOT_NZ)} ELSE {_q(L.SNAPSHOT_OVNZ)} END AS project_type,
        CASE WHEN l_returnflag = 'N' THEN 'SMRSsI' WHEN l_returnflag = 'R' THEN 'SMRSpI' ELSE 'SMRFull' END AS "Code",
        l_extendedprice * l_discount AS "f_act_Total",
        l_extendedprice AS "f_pln_Total"
    FROM lineitem_x
"""

VIEWS["raw_spider__calen_except"] = "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join([_q(code)] + [f"TIMESTAMP {_q(t)}" for t in ts]) + ")"
    for code, *ts in P.calendar_exceptions
) + ') AS t("Calen_Code", "Start", "Fin", "Start_true", "Fin_true")'

VIEWS["raw__vdc_by_objects"] = f"""
    SELECT
        c_name AS "{L.COL_WORK_NAME}",
        concat('CP-', CAST(c_custkey AS VARCHAR)) AS "{L.COL_CIPHER}",
        c_acctbal * 100.0 AS "{L.COL_CONTRACT_SMR}",
        n_name AS "object",
        c_acctbal / 100.0 AS "{L.COL_VOLUME}",
        c_mktsegment AS "{L.COL_UNITS}",
        c_acctbal AS "{L.COL_UNIT_PRICE}"
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

VIEWS["vdc_flawed"] = f"""
    SELECT c_name AS "{L.COL_WORK_NAME}",
        CASE WHEN c_custkey % 70 <> 0 THEN concat('CP-', CAST(c_custkey AS VARCHAR)) END AS "{L.COL_CIPHER}",
        c_acctbal * 100.0 AS "{L.COL_CONTRACT_SMR}",
        CASE WHEN c_custkey % 140 <> 0 THEN n_name END AS "object",
        c_acctbal / 100.0 AS "{L.COL_VOLUME}", c_mktsegment AS "{L.COL_UNITS}", c_acctbal AS "{L.COL_UNIT_PRICE}"
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (VALUES (1), (2)) AS t(copy)
      ON copy = 1 OR c_custkey % 50 = 0
"""

VIEWS["1_c__works"] = """
    SELECT
        concat('W', CAST(o_orderkey AS VARCHAR)) AS work_id,
        concat('Z', CAST(o_orderkey AS VARCHAR)) AS zhufvr_id,
        o_orderpriority AS type_work_name,
        o_orderstatus AS enrp_type,
        concat('K ', CAST(o_orderkey AS VARCHAR)) AS structure_unique_code,
        concat('OP- ', CAST(o_orderkey AS VARCHAR)) AS structure_works_code,
        (o_orderstatus = 'F') AS structure_is_delete
    FROM orders
"""

VIEWS["1_c__zhufvr"] = """
    SELECT
        concat('Z', CAST(o_orderkey AS VARCHAR)) AS link,
        CAST(c_nationkey AS VARCHAR) AS territory_value,
        o_orderdate AS zhfvr_date,
        CASE WHEN o_orderstatus = 'O' THEN 'day' ELSE 'night' END AS work_shift_name,
        (c_acctbal < 0) AS delete_flag,
        (o_orderstatus <> 'P') AS is_done
    FROM orders JOIN customer ON o_custkey = c_custkey
"""

VIEWS["dict__1c_objects_to_spider"] = """
    SELECT CAST(n_nationkey AS VARCHAR) AS territory_value,
           CASE WHEN n_regionkey = 0 THEN NULL ELSE n_name END AS spider_name
    FROM nation
"""

VIEWS["1_c__technique_workers"] = f"""
    SELECT
        concat('W', CAST(l_orderkey AS VARCHAR)) AS work_id,
        concat('S', CAST(l_suppkey AS VARCHAR)) AS analytics_value,
        concat(CASE WHEN min(l_linestatus) = 'O' THEN '(НТ) ' ELSE '' END, 'Supplier ',
               CAST(l_suppkey AS VARCHAR)) AS analytics_name,
        CASE WHEN max(l_tax) >= 0.05::DOUBLE THEN {_q(P.own_contractor_name)}
             WHEN max(l_tax) > 0 THEN concat({_q(P.hired_contractor_prefix)}, CAST(l_suppkey AS VARCHAR))
        END AS contragent_name,
        CASE WHEN max(l_tax) >= 0.05::DOUBLE THEN {_q(P.own_contractor_value)}
             ELSE concat('C', CAST(l_suppkey AS VARCHAR)) END AS contragent_value,
        concat('RES-', min(l_returnflag)) AS res_name,
        concat('RC-', min(l_returnflag)) AS res_code,
        CAST(sum(CAST(l_quantity * (1 - l_tax) AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS hours
    FROM lineitem
    WHERE l_returnflag <> 'A'
    GROUP BY l_orderkey, l_suppkey
"""

_NORM_CODE = ("CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'Mont' "
              "ELSE concat('RC-', l_returnflag) END")

VIEWS["1_c__norm_workload"] = f"""
    SELECT
        concat('W', CAST(l_orderkey AS VARCHAR)) AS work_id,
        concat('S', CAST(l_suppkey AS VARCHAR)) AS analytics_value,
        concat('Part ', CAST(l_partkey AS VARCHAR)) AS res_spider_name,
        {_NORM_CODE} AS res_spider_code,
        CAST(CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity * (1.26::DOUBLE - l_tax) END AS DECIMAL(18,4)) AS fact_workload,
        CAST(l_quantity * (1 - l_discount) AS DECIMAL(18,4)) AS norm_workload,
        (l_tax > 0.04::DOUBLE) AS nt_res
    FROM lineitem
    WHERE l_returnflag <> 'N'
"""

VIEWS["dict__spider_key_res"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_q(a)}, {_q(b)})" for a, b in P.key_resources) + ") AS t(f_opertype, rescode)"

VIEWS["dict__spider_kol_ekip"] = f"""
    SELECT {_NORM_CODE} AS "Code", max(l_quantity) / 10.0 AS "Kol_Ekip"
    FROM lineitem WHERE l_returnflag <> 'N'
    GROUP BY 1
"""

VIEWS["dict__fot"] = """
    SELECT res, "start", "start" + INTERVAL 2 MONTH AS finish, fot FROM (
        SELECT concat('RES-', l_returnflag) AS res, date_trunc('quarter', l_shipdate) AS "start",
               max(l_extendedprice / CASE WHEN l_quantity <> 0 THEN l_quantity END) / 100.0 AS fot
        FROM lineitem GROUP BY 1, 2)
"""

VIEWS["dict__mim"] = """
    SELECT res, "object", "start", "start" + INTERVAL 4 MONTH AS finish, leasing, repair, fuel FROM (
        SELECT concat('RES-', l_returnflag) AS res, n_name AS "object",
               date_trunc('quarter', o_orderdate) AS "start",
               max(l_extendedprice * l_discount) AS leasing,
               max(l_extendedprice * l_tax) AS repair,
               max(l_quantity) AS fuel
        FROM lineitem_x GROUP BY 1, 2, 3)
"""

# dependencies between views (a view may use those listed before it)
_DEPS = {
    "lineitem_x": ["orders_x"],
    "gandoper_project": ["orders_x"],
    "gandoper_snapshots": ["lineitem_x"],
    "raw_spider__gandoper": ["gandoper_project", "gandoper_snapshots"],
    "raw_spider__archive": ["lineitem_x"],
    "raw_spider__cost": ["lineitem_x"],
    "dict__mim": ["lineitem_x"],
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return [n for n in VIEWS if n in out]


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views (and what they depend on), ready for a query."""
    parts = [f'"{n}" AS ({VIEWS[n]})' for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n"
