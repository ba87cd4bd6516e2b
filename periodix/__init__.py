"""periodix: project-controls reporting as Spark DataFrame jobs.

Layout:
  sources/    driver-table loader, reference-shaped source frames derived from them, full-refresh sink
  functions/  PostgreSQL-compatible column expressions
  operators/  month spread, planned start, contract positions, validity-interval join, calendar adjust
  plans/      the jobs: plan/fact mart, hours reconciliation, cost comparison, data-quality checks, build
  streaming/  the month spread applied to a Structured Streaming source
"""

__version__ = "0.1.0"

from periodix.operators.calendar import adjust_calendar  # noqa: E402,F401
from periodix.operators.plan_start import plan_start  # noqa: E402,F401
from periodix.operators.positions import contract_positions  # noqa: E402,F401
from periodix.operators.skew import existence_flags, join_per_key  # noqa: E402,F401
from periodix.operators.spread import month_parts, month_weights  # noqa: E402,F401
from periodix.operators.validity import overlapping_intervals, validity_join  # noqa: E402,F401
from periodix.plans.build import build  # noqa: E402,F401
from periodix.plans.costs import CostParams, compare_costs  # noqa: E402,F401
from periodix.plans.hours import reconcile_hours  # noqa: E402,F401
from periodix.plans.plan_fact import fact_by_month, plan_by_month, plan_fact_mart  # noqa: E402,F401

__all__ = [
    "adjust_calendar", "plan_start", "contract_positions", "existence_flags", "join_per_key", "month_parts",
    "month_weights", "overlapping_intervals", "validity_join", "build", "CostParams", "compare_costs",
    "reconcile_hours", "fact_by_month", "plan_by_month", "plan_fact_mart",
]
