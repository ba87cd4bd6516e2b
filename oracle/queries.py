"""All oracle SQL, keyed like the query registry."""

from __future__ import annotations

from oracle import checks_sql, costs_sql, hours_sql, marts_sql, spread_sql

ORACLE: dict[str, str] = {
    "plan_start": spread_sql.PLAN_START,
    "plan_month_spread": spread_sql.PLAN_MONTH_SPREAD,
    "plan_month_spread_dup": spread_sql.PLAN_MONTH_SPREAD_DUP,
    "fact_month_spread": spread_sql.FACT_MONTH_SPREAD,
    "calendar_adjust": spread_sql.CALENDAR_ADJUST,
    "contract_positions": marts_sql.CONTRACT_POSITIONS,
    "plan_fact_mart": marts_sql.PLAN_FACT_MART,
    "hours_unnormed": hours_sql.HOURS_UNNORMED,
    "hours_normed": hours_sql.HOURS_NORMED,
    "hours_zero": hours_sql.HOURS_ZERO,
    "hours_mart": hours_sql.HOURS_MART,
    "validity_join": costs_sql.VALIDITY_JOIN,
    "rate_overlaps": costs_sql.RATE_OVERLAPS,
}


def _costs() -> str:
    from periodix.catalog import cost_params
    from periodix.sources.bindings import BindingParams

    class _W:  # cost_params only reads the binding parameters
        params = BindingParams()

    return costs_sql.costs_mart(cost_params(_W()))


def _checks() -> dict[str, str]:
    from periodix.catalog import COST_CHECK_EXCLUDED, FACT_NZ_EXCEPTION

    return {
        "check_fact_nz": checks_sql.fact_nz(FACT_NZ_EXCEPTION),
        "check_plan_ovnz": checks_sql.PLAN_OVNZ,
        "check_duplicate_projects": checks_sql.DUPLICATE_PROJECTS,
        "check_hours_total": checks_sql.HOURS_TOTAL,
        "check_oper_duplication": checks_sql.OPER_DUPLICATION,
        "check_grand_total": checks_sql.GRAND_TOTAL,
        "check_cost_components": checks_sql.cost_components(COST_CHECK_EXCLUDED),
        "check_contract_total": checks_sql.CONTRACT_TOTAL,
        "check_position_unique": checks_sql.POSITION_UNIQUE,
        "check_position_not_null": checks_sql.POSITION_NOT_NULL,
    }


ORACLE.update({
    "costs_mart": _costs(),
    **_checks(),
})

