"""Cost comparison: ERP hours priced with rates valid on the journal date,
against the planning system's actual costs per operation.

Whether an hour row counts depends on its work alone, so it is decided on the works table: two left joins against
distinct code sets give existence flags for the two ways to qualify. Only hours of qualifying works are joined and
then priced (:func:`validity_join`: equi keys and a half-open date range, by month). The planning side sums archive
resource rows per (operation, site) by partial aggregation and joins them to the operation's plan row. Money sums are
exact, so they do not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix import labels as L
from periodix.functions import replace_first, strip_spaces
from periodix.functions.sums import exact_sum
from periodix.operators.validity import validity_join


@dataclass(frozen=True)
class CostParams:
    """The reference's literals, as parameters."""

    own_contractor_value: str
    main_worker_analytics: str
    plan_objects: tuple[str, ...]          # sites of the first qualification set
    works_code_objects: tuple[str, ...]    # sites of the second (deleted works) set
    period_start: str                      # first period year start, e.g. '2022-01-01 00:00:00'
    period_mid: str                        # second period year start
    period_end: str                        # end of the second period year
    deleted_before: str                    # journal date limit for deleted works
    project_type: str = L.PROJECT


def _plan_rows(gandoper: DataFrame, p: CostParams, objects: Sequence[str]) -> DataFrame:
    return gandoper.where(
        (F.col("project_type") == p.project_type) & F.col("object").isin(*objects)
        & (F.col("Start") >= F.lit(p.period_start).cast("timestamp_ntz"))
        & (F.col("Fin") <= F.lit(p.period_end).cast("timestamp_ntz"))
        & F.col("WorkLoadFact").isNotNull())


def qualifying_works(works: DataFrame, zhufvr: DataFrame, objects: DataFrame, gandoper: DataFrame, p: CostParams) -> DataFrame:
    """(work_id, unique_code, day, site) of the works whose hours count.

    A work counts by its unique code among the planned operations of the first site list, or, when deleted and logged
    before the limit, by its works code among those of the second list.
    """
    by_unique = _plan_rows(gandoper, p, p.plan_objects).select(F.col("f_CodeIdent").alias("unique_code")).distinct()
    by_works = _plan_rows(gandoper, p, p.works_code_objects).select(
        replace_first(F.col("Code"), L.CODE_PREFIX_TO_STRIP).alias("works_code")).distinct()
    journal = zhufvr.select(F.col("link").alias("zhufvr_id"), "territory_value", F.col("zhfvr_date").alias("day"))
    sites = objects.select("territory_value", F.col("spider_name").alias("site"))
    rows = works.select("work_id", "zhufvr_id", strip_spaces("structure_unique_code").alias("unique_code"),
                        strip_spaces("structure_works_code").alias("works_code"),
                        (F.col("structure_is_delete") == F.lit(True)).alias("deleted"))
    rows = rows.join(journal, "zhufvr_id", "left").join(sites, "territory_value", "left")
    rows = rows.join(by_unique.withColumn("_planned", F.lit(True)), "unique_code", "left")
    rows = rows.join(by_works.withColumn("_listed", F.lit(True)), "works_code", "left")
    late = F.col("deleted") & (F.col("day") < F.lit(p.deleted_before).cast("timestamp_ntz"))
    return rows.where(F.col("_planned") | (F.col("_listed") & late)).select("work_id", "unique_code", "day", "site")


def erp_costs(tw: DataFrame, qualified: DataFrame, fot: DataFrame, mim: DataFrame, kol_ekip: DataFrame, p: CostParams) -> DataFrame:
    """Hours of qualifying works, priced with the rates valid on their day, summed per (unique code, site)."""
    own = F.coalesce((F.col("contragent_value") == p.own_contractor_value)
                     | (F.col("analytics_value") == p.main_worker_analytics), F.lit(False))
    rows = tw.select("work_id", "res_name", "res_code", "hours", own.alias("own")).join(qualified, "work_id")
    wages = fot.select(F.col("res").alias("_w_res"), F.col("start").alias("_w_from"), F.col("finish").alias("_w_to"), "fot")
    rows = validity_join(rows, wages, [("res_name", "_w_res")], "day", "_w_from", "_w_to")
    machines = mim.select(F.col("res").alias("_m_res"), F.col("object").alias("_m_site"), F.col("start").alias("_m_from"),
                          F.col("finish").alias("_m_to"), "leasing", "repair", "fuel")
    rows = validity_join(rows, machines, [("res_name", "_m_res"), ("site", "_m_site")], "day", "_m_from", "_m_to")
    rows = rows.join(kol_ekip.select(F.col("Code").alias("res_code"), F.col("Kol_Ekip").alias("crew")), "res_code", "left")
    hours, mine = F.col("hours"), F.col("own")
    rows = rows.select("unique_code", "site", "hours", "own", (hours * F.col("fot") * F.col("crew")).alias("fot"),
                       *[(hours * F.col(rate)).alias(rate) for rate in ("leasing", "repair", "fuel")])
    money = rows.withColumns({c: F.when(mine, F.col(c)) for c in ("fot", "leasing", "repair", "fuel")})
    return money.groupBy("unique_code", "site").agg(
        F.sum(hours).alias("hours"),
        F.sum(F.when(mine, hours)).alias("own_hours"),
        F.sum(F.when(~mine, hours)).alias("nt_hours"),
        *[exact_sum(F.col(c)).alias(c) for c in ("fot", "leasing", "repair", "fuel")])


def planning_costs(archive: DataFrame, gandoper: DataFrame, p: CostParams) -> DataFrame:
    """Archive resource workload per (operation, site) with the operation's plan row."""
    res = archive.where((F.col("project_type") == p.project_type) & F.col("ResCode").isNotNull())
    hired, wl = F.col("ResCode").like(L.HIRED_RESCODE_PATTERN), F.col("WorkLoadFact")
    rows = res.select("OperCode", "object", wl.alias("wrkld"), F.when(hired, wl).alias("nt_wrkld"), F.when(~hired, wl).alias("own_wrkld"))
    sums = rows.groupBy("OperCode", "object").agg(*[exact_sum(F.col(c)).alias(c) for c in ("wrkld", "nt_wrkld", "own_wrkld")])
    plan = gandoper.where(F.col("project_type") == p.project_type).select(
        "f_CodeIdent", F.col("Code").alias("_g_code"), "Name", "c_act_AmLiz", "c_act_RepMiM", "c_act_FuelMiM",
        "c_act_FnOpTr", F.col("object").alias("_g_object"), "Start", "Fin")
    joined = sums.join(plan, (F.col("OperCode") == F.col("_g_code")) & (F.col("object") == F.col("_g_object")),
                       "left")
    return joined.select("object", "f_CodeIdent", "Name", "wrkld", "nt_wrkld", "own_wrkld", "c_act_AmLiz",
                         "c_act_RepMiM", "c_act_FuelMiM", "c_act_FnOpTr", "Start", "Fin")


def compare_costs(tw: DataFrame, works: DataFrame, zhufvr: DataFrame, objects: DataFrame, fot: DataFrame,
                  mim: DataFrame, kol_ekip: DataFrame, gandoper: DataFrame, archive: DataFrame,
                  p: CostParams) -> DataFrame:
    """The cost-comparison mart: one row per qualifying (structure code, site)."""
    qualified = qualifying_works(works, zhufvr, objects, gandoper, p)
    erp = erp_costs(tw, qualified, fot, mim, kol_ekip, p)
    plan_side = planning_costs(archive, gandoper, p).withColumnRenamed("object", "_p_object")
    out = erp.join(plan_side, (F.col("unique_code") == F.col("f_CodeIdent")) & (F.col("site") == F.col("_p_object")), "left")
    c = F.col
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    first, second = p.period_start[:4], p.period_mid[:4]
    period = (F.when((c("Start") >= ts(p.period_start)) & (c("Fin") <= ts(p.period_mid)), F.lit(first))
              .when((c("Start") >= ts(p.period_mid)) & (c("Fin") <= ts(p.period_end)), F.lit(second))
              .otherwise(F.lit(L.MIXED_PERIOD_TEMPLATE.format(first=first, second=second))))
    z = lambda name: F.coalesce(c(name), F.lit(0.0))
    return out.select(
        c("site").alias("object"),
        c("unique_code").alias("structure_unique_code"), "Name", "hours", "own_hours", "nt_hours",
        c("fot").alias("fot_1c"), c("leasing").alias("leasing_1c"), c("repair").alias("repair_1c"),
        c("fuel").alias("fuel_1c"),
        (z("fot") + z("leasing") + z("repair") + z("fuel")).alias("cost_1c"),
        "wrkld", "nt_wrkld", "own_wrkld",
        c("c_act_AmLiz").alias("leasing_sp"), c("c_act_RepMiM").alias("repair_sp"),
        c("c_act_FuelMiM").alias("fuel_sp"), c("c_act_FnOpTr").alias("fot_sp"),
        (z("c_act_AmLiz") + z("c_act_RepMiM") + z("c_act_FuelMiM") + z("c_act_FnOpTr")).alias("cost_sp"),
        period.alias("period"),
    )
