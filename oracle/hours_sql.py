"""Oracle SQL for the hours reconciliation (J6).

Formulated independently of the Spark code: existence of norm keys becomes flags from left joins on
distinct key sets; branch B ranks rows with a window (sum and row_number over the group).
"""

from __future__ import annotations

from oracle.bindings import P, with_views
from periodix import labels as L
from periodix.plans.hours import B_TIE_BREAK


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PH = ", ".join(_q(p) for p in P.placeholder_analytics)
_OWN_L, _HIRED_L = _q(L.OWN_RESOURCE), _q(L.HIRED_RESOURCE)

# ownership from the contractor name when there is one, else from the analytics prefix
_OWNER = f"""CASE
        WHEN h.contragent_name IS NOT NULL
            THEN CASE WHEN h.contragent_name = {_q(P.own_contractor_name)} THEN {_OWN_L} ELSE {_HIRED_L} END
        WHEN h.analytics_name IS NOT NULL
            THEN CASE WHEN h.analytics_name LIKE {_q(L.HIRED_PREFIX_PATTERN)} THEN {_HIRED_L} ELSE {_OWN_L} END
    END"""

_COLS = {
    "res_spider_name": "n.res_spider_name", "fact_workload": "n.fact_workload",
    "norm_workload": "n.norm_workload", "nt_res": "n.nt_res", "object": "lw.site", "raw_hours": "h.hours",
    "type_work_name": "lw.type_work_name", "enrp_type": "lw.enrp_type",
    "structure_unique_code": "lw.structure_unique_code", "zhfvr_date": "lw.zhfvr_date",
    "work_shift_name": "lw.work_shift_name",
}
_RANK_ORDER = ", ".join(["n.res_spider_code IS NULL DESC", "n.res_spider_code DESC"]
                        + [f"{_COLS[c]} DESC NULLS LAST" for c in B_TIE_BREAK])

_BASE = f""",
live_work AS (
    SELECT w.work_id, w.type_work_name, w.enrp_type, w.structure_unique_code,
           j.zhfvr_date, j.work_shift_name, s.spider_name AS site
    FROM "1_c__works" AS w
    JOIN "1_c__zhufvr" AS j ON j.link = w.zhufvr_id
    JOIN dict__1c_objects_to_spider AS s ON s.territory_value = j.territory_value
    WHERE j.delete_flag = false AND j.is_done = true AND s.spider_name IS NOT NULL
),
norm_keys AS (SELECT DISTINCT work_id, analytics_value FROM "1_c__norm_workload"),
zero_keys AS (SELECT DISTINCT work_id, analytics_value FROM "1_c__norm_workload" WHERE fact_workload = 0),
raw_flagged AS (
    SELECT h.*, lw.type_work_name, lw.enrp_type, lw.site, lw.structure_unique_code, lw.zhfvr_date,
           lw.work_shift_name,
           coalesce(h.analytics_value NOT IN ({_PH}), false) AS countable,
           nk.work_id IS NOT NULL AS has_norm,
           zk.work_id IS NOT NULL AS has_zero_norm,
           {_OWNER} AS owner
    FROM "1_c__technique_workers" AS h
    JOIN live_work AS lw ON lw.work_id = h.work_id
    LEFT JOIN norm_keys AS nk ON nk.work_id = h.work_id AND nk.analytics_value = h.analytics_value
    LEFT JOIN zero_keys AS zk ON zk.work_id = h.work_id AND zk.analytics_value = h.analytics_value
),
unnormed AS (
    SELECT site AS "object", work_id, type_work_name AS "{L.COL_WORK_KIND}", enrp_type AS "{L.COL_ENRP_TYPE}",
           res_name AS "{L.COL_SPIDER_RESOURCE}", res_code AS "{L.COL_RESOURCE_CODE}",
           hours AS "{L.COL_FACT_HOURS}", coalesce(nullif(hours, 0), 0) AS "{L.COL_NORM_HOURS}",
           false AS "{L.COL_NORMED}", owner AS "{L.COL_RESOURCE}",
           structure_unique_code, zhfvr_date, work_shift_name
    FROM raw_flagged WHERE NOT (has_norm AND countable)
),
zero_normed AS (
    SELECT site AS "object", work_id, type_work_name AS "{L.COL_WORK_KIND}", enrp_type AS "{L.COL_ENRP_TYPE}",
           res_name AS "{L.COL_SPIDER_RESOURCE}", res_code AS "{L.COL_RESOURCE_CODE}",
           hours AS "{L.COL_FACT_HOURS}", coalesce(nullif(hours, 0), 0) AS "{L.COL_NORM_HOURS}",
           true AS "{L.COL_NORMED}", owner AS "{L.COL_RESOURCE}",
           structure_unique_code, zhfvr_date, work_shift_name
    FROM raw_flagged WHERE has_zero_norm AND countable
),
ranked AS (
    SELECT n.*, lw.site, lw.type_work_name, lw.enrp_type, lw.structure_unique_code, lw.zhfvr_date,
           lw.work_shift_name, h.hours AS raw_hours,
           sum(n.fact_workload) OVER (PARTITION BY n.work_id, n.analytics_value) AS group_fact,
           row_number() OVER (PARTITION BY n.work_id, n.analytics_value ORDER BY {_RANK_ORDER}) AS pos
    FROM "1_c__norm_workload" AS n
    JOIN live_work AS lw ON lw.work_id = n.work_id
    LEFT JOIN "1_c__technique_workers" AS h ON h.work_id = n.work_id AND h.analytics_value = n.analytics_value
    WHERE n.fact_workload <> 0
),
normed AS (
    SELECT site AS "object", work_id, type_work_name AS "{L.COL_WORK_KIND}", enrp_type AS "{L.COL_ENRP_TYPE}",
           res_spider_name AS "{L.COL_SPIDER_RESOURCE}", res_spider_code AS "{L.COL_RESOURCE_CODE}",
           CASE WHEN pos = 1 AND res_spider_code = {_q(L.MAIN_WORKER_CODE)} AND group_fact > raw_hours + 1
                    THEN fact_workload - group_fact + raw_hours
                WHEN analytics_value IN ({_PH}) THEN 0
                ELSE fact_workload END AS "{L.COL_FACT_HOURS}",
           norm_workload AS "{L.COL_NORM_HOURS}", true AS "{L.COL_NORMED}",
           CASE nt_res WHEN false THEN {_OWN_L} WHEN true THEN {_HIRED_L} END AS "{L.COL_RESOURCE}",
           structure_unique_code, zhfvr_date, work_shift_name
    FROM ranked
)"""

_HOURS = (L.COL_FACT_HOURS, L.COL_NORM_HOURS)


def _final(alias: str = "") -> str:
    """The branches' columns; hours, decimals so far, as doubles."""
    names = ["object", "work_id", L.COL_WORK_KIND, L.COL_ENRP_TYPE, L.COL_SPIDER_RESOURCE, L.COL_RESOURCE_CODE, *_HOURS, L.COL_NORMED, L.COL_RESOURCE]
    return ", ".join(f'CAST({alias}"{c}" AS DOUBLE) AS "{c}"' if c in _HOURS else f'{alias}"{c}"' for c in names)


def rounded_percent(value: str, base: str) -> str:
    """(value / base - 1) in percent to two decimals, ties away from zero, in whole ten-thousandths; null for a zero base."""
    v, b = (f"CAST({x} * 10000 AS HUGEINT)" for x in (value, base))
    return f"CAST(sign({v} - {b}) * sign({b}) * ((2 * abs(({v} - {b}) * 10000) + abs({b})) // nullif(2 * abs({b}), 0)) AS DOUBLE) / 100"


_HOURS_VIEWS = ("1_c__technique_workers", "1_c__norm_workload", "1_c__works", "1_c__zhufvr",
                "dict__1c_objects_to_spider")

HOURS_UNNORMED = with_views(*_HOURS_VIEWS) + _BASE + f"\nSELECT {_final()} FROM unnormed\n"
HOURS_NORMED = with_views(*_HOURS_VIEWS) + _BASE + f"\nSELECT {_final()} FROM normed\n"
HOURS_ZERO = with_views(*_HOURS_VIEWS) + _BASE + f"\nSELECT {_final()} FROM zero_normed\n"

HOURS_MART = with_views(*_HOURS_VIEWS, "raw_spider__gandoper", "raw__vdc_by_objects", "dict__spider_key_res") + _BASE + f""",
all_rows AS (
    SELECT * FROM unnormed UNION ALL SELECT * FROM normed UNION ALL SELECT * FROM zero_normed
),
plan_ops AS (
    SELECT "f_CodeIdent", "object", "SNT_Knstr", "SNT_KnstrE", "Num_Con"
    FROM raw_spider__gandoper WHERE project_type = {_q(L.PROJECT)}
),
positions AS (
    SELECT "{L.COL_CIPHER}" AS cipher, "object",
           concat("{L.COL_CIPHER}", '    ', "{L.COL_WORK_NAME}") AS label
    FROM raw__vdc_by_objects
)
SELECT {_final("a.")},
    a.structure_unique_code,
    CASE WHEN p."SNT_Knstr" IN ({_q(L.EARTHWORK)}, {_q(L.PAVEMENT)}) THEN p."SNT_Knstr" ELSE {_q(L.OTHER_WORKS)} END
        AS "{L.COL_STRUCTURE}",
    p."SNT_KnstrE" AS "{L.COL_STRUCTURE_ELEMENT}",
    pos.label AS "{L.COL_POSITION}",
    a.zhfvr_date AS "{L.COL_DATE}",
    a.work_shift_name AS "{L.COL_SHIFT}",
    CAST(year(a.zhfvr_date) AS INTEGER) AS "{L.COL_YEAR}",
    CAST(month(a.zhfvr_date) AS INTEGER) AS "{L.COL_MONTH}",
    abs({rounded_percent(f'a."{L.COL_FACT_HOURS}"', f'a."{L.COL_NORM_HOURS}"')}) AS "{L.COL_DEVIATION}",
    k.rescode IS NOT NULL AS "{L.COL_KEY_RESOURCE}"
FROM all_rows AS a
JOIN plan_ops AS p ON p."f_CodeIdent" = replace(a.structure_unique_code, ' ', '') AND p."object" = a."object"
LEFT JOIN positions AS pos ON pos.cipher = p."Num_Con" AND pos."object" = a."object"
LEFT JOIN dict__spider_key_res AS k ON k.f_opertype = a."{L.COL_ENRP_TYPE}" AND k.rescode = a."{L.COL_RESOURCE_CODE}"
"""
