"""Oracle SQL for the data-quality checks (Q1-Q10), formulated independently: flagged groups via
HAVING, mismatch counts per side, scalar totals."""

from __future__ import annotations

from oracle.bindings import with_views
from oracle.hours_sql import rounded_percent
from oracle.marts_sql import mart_prefix, positions_select
from oracle.sums import exact_sum
from periodix import labels as L


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _dsum(expr: str) -> str:
    return exact_sum(expr)


_KEYS = '"object", nz_year, nz_month, project_type'


def _flagged(project_type: str, measure: str, status: str) -> str:
    return f"""
SELECT {_KEYS}, {_q(status)} AS status
FROM raw_spider__gandoper
WHERE project_type = {_q(project_type)}
GROUP BY {_KEYS}
HAVING {_dsum(chr(34) + measure + chr(34))} <> 0"""


def fact_nz(exception: tuple[str, str, str]) -> str:
    obj, year, month = exception
    return with_views("raw_spider__gandoper") + f""",
flagged AS ({_flagged(L.SNAPSHOT_NZ, "s_act_CC_SMRFull", L.STATUS_FACT_IN_NZ)})
SELECT * FROM flagged
WHERE NOT ("object" = {_q(obj)} AND nz_year = {_q(year)} AND nz_month = {_q(month)}
           AND project_type = {_q(L.SNAPSHOT_NZ)})
"""


PLAN_OVNZ = with_views("raw_spider__gandoper") + _flagged(L.SNAPSHOT_OVNZ, "s_pln_CC_SMRFull", L.STATUS_PLAN_IN_OVNZ) + "\n"

DUPLICATE_PROJECTS = with_views("raw_spider__gandoper") + f"""
SELECT {_KEYS}, {_q(L.STATUS_DUPLICATE)} AS status
FROM raw_spider__gandoper
GROUP BY {_KEYS}, concat(nz_year, nz_month, project_type, "Code")
HAVING count(*) > 1
"""

HOURS_TOTAL = with_views("1_c__technique_workers", "1_c__norm_workload") + f""",
norm_keys AS (SELECT DISTINCT work_id, analytics_value FROM "1_c__norm_workload"),
reconciled AS (
    SELECT h.hours AS v FROM "1_c__technique_workers" AS h
    LEFT JOIN norm_keys AS k ON k.work_id = h.work_id AND k.analytics_value = h.analytics_value
    WHERE k.work_id IS NULL
    UNION ALL
    SELECT fact_workload FROM "1_c__norm_workload"
),
totals AS (
    SELECT (SELECT sum(v) FROM reconciled) AS rec,
           (SELECT sum(hours) FROM "1_c__technique_workers") AS raw
),
delta AS (SELECT {rounded_percent('rec', 'raw')} AS delta_hours FROM totals)
SELECT delta_hours FROM delta WHERE delta_hours >= 0.1
"""

OPER_DUPLICATION = mart_prefix() + f""",
raw_plan AS (
    SELECT "object", "Code" AS code,
           {_dsum('coalesce("c_pln_SMRSsI", 0) + coalesce("c_pln_SMRSpI", 0)')} AS total
    FROM raw_spider__gandoper
    WHERE project_type = {_q(L.PROJECT)} AND ("c_pln_SMRSsI" IS NOT NULL OR "c_pln_SMRSpI" IS NOT NULL)
    GROUP BY "object", "Code"
),
raw_fact AS (
    SELECT "object", "OperCode" AS code,
           {_dsum('coalesce("c_aac_SMRSsI", 0) + coalesce("c_aac_SMRSpI", 0)')} AS total
    FROM raw_spider__archive
    WHERE project_type = {_q(L.PROJECT)} AND "ResCode" IS NULL
      AND ("c_aac_SMRSsI" IS NOT NULL OR "c_aac_SMRSpI" IS NOT NULL)
    GROUP BY "object", "OperCode"
),
mart_totals AS (
    SELECT smr_type, "object", code, {_dsum('coalesce(smr_ss, 0) + coalesce(smr_sp, 0)')} AS total
    FROM mart WHERE smr_ss IS NOT NULL OR smr_sp IS NOT NULL
    GROUP BY smr_type, "object", code
),
mismatches AS (
    SELECT 'plan' AS side FROM raw_plan AS r
    JOIN mart_totals AS m ON m.smr_type = {_q(L.PLAN)} AND m.code = r.code AND m."object" = r."object"
    WHERE abs(r.total - m.total) > 1
    UNION ALL
    SELECT 'fact' FROM raw_fact AS r
    JOIN mart_totals AS m ON m.smr_type = {_q(L.FACT)} AND m.code = r.code AND m."object" = r."object"
    WHERE abs(r.total - m.total) > 1
)
SELECT DISTINCT count(*) AS "count" FROM mismatches GROUP BY side
"""

GRAND_TOTAL = mart_prefix() + f""",
totals AS (
    SELECT
        (SELECT {_dsum('smr_sp')} + {_dsum('smr_ss')} FROM mart) AS fin,
        (SELECT {_dsum('"c_pln_SMRSsI"')} + {_dsum('"c_pln_SMRSpI"')}
         FROM raw_spider__gandoper WHERE project_type = {_q(L.PROJECT)})
        + (SELECT {_dsum('"c_aac_SMRSsI"')} + {_dsum('"c_aac_SMRSpI"')}
           FROM raw_spider__archive WHERE project_type = {_q(L.PROJECT)}) AS raw
)
SELECT round(fin, 2) AS fin_total_smr, round(raw, 2) AS raw_total FROM totals WHERE abs(raw - fin) > 10000
"""


def cost_components(excluded_object: str) -> str:
    link = 'concat("object", nz_year, nz_month, project_type)'
    return with_views("raw_spider__gandoper", "raw_spider__cost") + f""",
op_totals AS (
    SELECT {_KEYS}, {link} AS link,
           {_dsum('coalesce("s_act_CC_SMRSsI", 0)')} + {_dsum('coalesce("s_act_CC_SMRSpI", 0)')} AS fact,
           {_dsum('coalesce("s_pln_CC_SMRSsI", 0)')} + {_dsum('coalesce("s_pln_CC_SMRSpI", 0)')} AS plan
    FROM raw_spider__gandoper GROUP BY {_KEYS}, {link}
),
component_totals AS (
    SELECT {link} AS link, {_dsum('"f_act_Total"')} AS fact, {_dsum('"f_pln_Total"')} AS plan
    FROM raw_spider__cost WHERE "Code" IN ('SMRSsI', 'SMRSpI')
    GROUP BY {link}
)
SELECT o."object", o.nz_year, o.nz_month, o.project_type, {_q(L.STATUS_ERROR)} AS status
FROM op_totals AS o JOIN component_totals AS c ON c.link = o.link
WHERE NOT coalesce(round_even(o.fact / 10000, 0) = round_even(c.fact / 10000, 0), false)
  AND NOT coalesce(round_even(o.plan / 10000, 0) = round_even(c.plan / 10000, 0), false)
  AND o."object" <> {_q(excluded_object)}
"""


CONTRACT_TOTAL = with_views("raw_spider__gandoper", "raw__vdc_by_objects") + f""",
site_totals AS (
    SELECT "object",
           CAST(sum(round(CAST(coalesce("s_act_CC_SMRFull", 0) + coalesce("s_pln_CC_SMRFull", 0)
                               AS DECIMAL(38,10)), 2)) AS DOUBLE) AS project
    FROM raw_spider__gandoper WHERE project_type = {_q(L.PROJECT)}
    GROUP BY "object"
),
contract_totals AS (
    SELECT "object", CAST(round(sum(CAST("{L.COL_CONTRACT_SMR}" AS DECIMAL(38,10))), 2) AS DOUBLE) AS contract
    FROM raw__vdc_by_objects GROUP BY "object"
),
compared AS (
    SELECT s."object", s.project, c.contract,
           round((s.project / nullif(c.contract, 0) - 1) * 100, 3) AS pct
    FROM site_totals AS s LEFT JOIN contract_totals AS c ON c."object" = s."object"
)
SELECT "object", project AS sum_smr_sp, contract AS sum_smr_vdc, project - contract AS delta, pct AS "%_delta"
FROM compared WHERE abs(pct) > 10
"""

POSITION_UNIQUE = with_views("vdc_flawed") + f"""
SELECT unique_test, count(*) AS n_records FROM ({positions_select("vdc_flawed")}) AS p
WHERE unique_test IS NOT NULL GROUP BY unique_test HAVING count(*) > 1
"""

POSITION_NOT_NULL = with_views("vdc_flawed") + f"""
SELECT "{L.COL_CIPHER}", "object", unique_test FROM ({positions_select("vdc_flawed")}) AS p
WHERE "{L.COL_CIPHER}" IS NULL OR "object" IS NULL
"""
