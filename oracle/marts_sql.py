"""Oracle SQL for contract positions (J1) and the plan/fact mart (J5).

The mart is an operation's dimensions, computed once per operation with its contract position, attached to every
month row of that operation's code and site.
"""

from __future__ import annotations

from oracle.spread_sql import fact_ctes, plan_ctes, recursive_views
from periodix import labels as L


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def positions_select(table: str = "raw__vdc_by_objects") -> str:
    """Contract positions with their label and key; both skip null parts."""
    columns = ", ".join(f'"{c}"' for c in (L.COL_WORK_NAME, L.COL_CIPHER, L.COL_CONTRACT_SMR, "object", L.COL_VOLUME, L.COL_UNITS,
                                           L.COL_UNIT_PRICE))
    label = f"""concat("{L.COL_CIPHER}", repeat(' ', 4), "{L.COL_WORK_NAME}") AS "{L.COL_POSITION}\""""
    key = f"""concat("{L.COL_CIPHER}", repeat(' ', 4), "object") AS unique_test"""
    return f"SELECT {columns}, {label}, {key} FROM {table}"


CONTRACT_POSITIONS = recursive_views("raw__vdc_by_objects") + "\n" + positions_select() + "\n"

_DIMENSIONS = ["Name", "Ispol", "IspolUch", "SNT_Knstr", "SNT_KnstrE", "SNT_TypeKnstrE", "SNT_Obj", "Num_Con"]
_POSITION = [L.COL_WORK_NAME, L.COL_POSITION, L.COL_CONTRACT_SMR]
_MODES = "MAP {" + ", ".join(f"{_q(a)}: {_q(b)}" for a, b in L.DELIVERY_MODE_MAP.items()) + "}"

MART_CTES = f""",
    operation_dims AS (
        SELECT "Code" AS code, o."object", {", ".join(f'"{c}"' for c in _DIMENSIONS)},
            {_MODES}[coalesce("Real", '')] AS "{L.COL_DELIVERY_MODE}",
            if(coalesce("SNT_Knstr", '') IN ({_q(L.EARTHWORK)}, {_q(L.PAVEMENT)}), "SNT_Knstr", {_q(L.OTHER_WORKS)}) AS "{L.COL_STRUCTURE}",
            {", ".join(f'c."{x}"' for x in _POSITION)}
        FROM raw_spider__gandoper AS o
        LEFT JOIN ({positions_select()}) AS c ON (c."{L.COL_CIPHER}", c."object") = ("Num_Con", o."object")
        WHERE project_type = {_q(L.PROJECT)}
    ),
    month_rows AS (
        FROM (SELECT * EXCLUDE (gant_index) FROM plan_months) UNION ALL BY NAME FROM (SELECT * EXCLUDE (archive_index) FROM fact_months)
    ),
    mart AS (
        SELECT *, if(start_month IS NULL, '0', printf('%02d', start_month)) AS s_month
        FROM month_rows JOIN operation_dims USING (code, "object")
    )"""


def mart_prefix(*extra_views: str) -> str:
    """``WITH RECURSIVE`` prefix defining the views, both spreads and the CTE ``mart``."""
    return (recursive_views("raw_spider__gandoper", "raw_spider__archive", "raw__vdc_by_objects", *extra_views)
            + "," + plan_ctes("raw_spider__gandoper", False) + "," + fact_ctes() + MART_CTES)


PLAN_FACT_MART = mart_prefix() + "\nSELECT * FROM mart\n"
