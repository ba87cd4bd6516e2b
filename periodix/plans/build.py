"""The whole build: every model as a full-refresh table in dependency order, then the checks.

Order (the reference's dependency graph): contract positions, plan spread, fact spread, plan/fact
mart, hours mart, cost comparison; then the data-quality checks, which read the written tables. Each
step is its own Spark job over written inputs, so a failure or a lost executor costs one step, and no
step recomputes its upstream models. Violations are written as tables too; only their counts reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodix.operators.calendar import adjust_calendar
from periodix.operators.plan_start import plan_start
from periodix.operators.positions import contract_positions
from periodix.operators.spread import month_parts
from periodix.operators.validity import overlapping_intervals
from periodix.plans import checks as Q
from periodix.plans.costs import CostParams, compare_costs
from periodix.plans.hours import reconcile_hours
from periodix.plans.plan_fact import fact_by_month, plan_by_month, plan_fact_mart
from periodix.sources.sinks import write_bucketed, write_table


@dataclass
class Sources:
    """The reference's source tables as DataFrames (e.g. a :class:`periodix.sources.bindings.World`)."""

    gandoper: DataFrame
    archive: DataFrame
    cost: DataFrame
    vdc: DataFrame
    technique_workers: DataFrame
    norm_workload: DataFrame
    works: DataFrame
    zhufvr: DataFrame
    objects: DataFrame
    key_res: DataFrame
    kol_ekip: DataFrame
    fot: DataFrame
    mim: DataFrame
    calen_except: DataFrame


@dataclass
class BuildParams:
    own_contractor_name: str
    placeholder_analytics: tuple[str, ...]
    costs: CostParams
    plan_unique_key: bool = False
    fact_nz_exception: tuple[str, str, str] | None = None
    cost_check_excluded: str | None = None


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raises if a key occurs twice (null key parts are left out): results would be wrong without a trace."""
    repeated = df.dropna("any", subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{what} must be unique: {', '.join(keys)}")


def build(spark: SparkSession, src: Sources, params: BuildParams, base: str) -> dict[str, int]:
    """Write every model, and the violations of every check, under ``base``; return the violation counts.

    ``base`` must be a folder that the driver and all executors share. The keys that the jobs take to be unique are
    checked first.
    """
    require_unique(src.works, ["work_id"], "works")
    require_unique(src.zhufvr, ["link"], "journal entries")
    starts = plan_start(src.gandoper)
    if params.plan_unique_key:
        require_unique(starts, ["gant_index", "code"], "project operations")
    starts.createOrReplaceTempView("plan_start")
    parts = month_parts(starts, ["gant_index", "code"], "start_date", "end_date", carry=["project_type", "object", "Calen"],
                        unique_key=params.plan_unique_key, keep_all=True)
    adjusted = adjust_calendar(parts.select("gant_index", "code", "project_type", "object", "Calen", "part_start", "part_end"),
                               src.calen_except)
    write_table(adjusted, base, "calendar_adjust")
    positions = write_table(contract_positions(src.vdc), base, "contract_positions")
    # the month-grained tables are joined and checked by operation and site: they lie in buckets by these keys, and the
    # mart in folders by year as well, so readers that filter on a period prune directories
    operation = ["code", "object"]
    plan = write_bucketed(plan_by_month(src.gandoper, unique_key=params.plan_unique_key), base, "plan_by_month", operation)
    fact = write_bucketed(fact_by_month(src.archive), base, "fact_by_month", operation)
    mart = write_bucketed(plan_fact_mart(plan, fact, src.gandoper, positions), base, "plan_fact_mart", operation,
                          partition_by=["start_year"])
    write_table(reconcile_hours(src.technique_workers, src.norm_workload, src.works, src.zhufvr, src.objects,
                                src.gandoper, positions, src.key_res, params.own_contractor_name,
                                params.placeholder_analytics), base, "hours_mart")
    write_table(compare_costs(src.technique_workers, src.works, src.zhufvr, src.objects, src.fot, src.mim,
                              src.kol_ekip, src.gandoper, src.archive, params.costs), base, "costs_mart")
    slices = write_table(Q.slice_totals(src.gandoper), base, "slice_totals")  # one pass for two checks
    checks = {
        "check_fact_nz": Q.fact_in_plan_slices(slices, params.fact_nz_exception),
        "check_plan_ovnz": Q.plan_in_fact_slices(slices),
        "check_duplicate_projects": Q.check_duplicate_projects(src.gandoper),
        "check_hours_from_1c": Q.check_hours_total(src.technique_workers, src.norm_workload),
        "check_duplication_of_oper": Q.check_oper_duplication(src.gandoper, src.archive, mart),
        "check_mart_grand_total": Q.check_grand_total(src.gandoper, src.archive, mart),
        "check_cost_components": Q.check_cost_components(src.gandoper, src.cost, params.cost_check_excluded),
        "check_contract_total": Q.check_contract_total(src.gandoper, src.vdc),
        "unique_position_key": Q.check_position_unique(positions),
        "not_null_position_key": Q.check_position_not_null(positions),
        "wage_rate_overlaps": overlapping_intervals(src.fot, ["res"]),
        "machine_rate_overlaps": overlapping_intervals(src.mim, ["res", "object"]),
    }
    return {name: write_table(rows, base, f"violations/{name}").count() for name, rows in checks.items()}


def params_from_json(path: str) -> BuildParams:
    """Build parameters from a JSON file (keys as in :class:`BuildParams`; ``costs`` as in
    :class:`periodix.plans.costs.CostParams`)."""
    import json

    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    costs = CostParams(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.pop("costs").items()})
    for key in ("placeholder_analytics", "fact_nz_exception"):
        if isinstance(raw.get(key), list):
            raw[key] = tuple(raw[key])
    return BuildParams(costs=costs, **raw)


def main(argv: list[str] | None = None) -> dict[str, int]:
    """``spark-submit periodix/plans/build.py SOURCES_DIR PARAMS_JSON OUTPUT_DIR``.

    Reads the source-table exports under SOURCES_DIR (one parquet folder per table, see
    :mod:`periodix.sources.raw`), writes every model under OUTPUT_DIR, a folder that the driver
    and all executors share, and prints the check report.
    """
    import json
    import sys

    from periodix.session import configure
    from periodix.sources.raw import raw_sources

    args = sys.argv[1:] if argv is None else argv
    spark = configure(SparkSession.builder.getOrCreate())
    counts = build(spark, raw_sources(spark, args[0]), params_from_json(args[1]), args[2])
    print(json.dumps(counts, ensure_ascii=False))
    return counts


if __name__ == "__main__":
    main()
