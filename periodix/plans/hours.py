"""Hours reconciliation: two overlapping ERP hour logs combined into one mart.

Three branches, each restricted to works whose shift journal is not deleted and is done, on a mapped
site:

* A, unnormed: raw hours with no norm row for the same (work, analytics) -- ``left_anti``; rows with a
  placeholder analytics value always land here.
* B, normed: norm rows with non-zero fact hours. The first row of its (work, analytics) group, by
  resource code descending (nulls first), when that code is the main-worker code and the group's fact
  total exceeds the raw hours + 1, gives up the excess; placeholder analytics get 0 hours.
* C, normed with zero: raw hours that have a zero-fact norm row -- ``left_semi``.

Hours are ``decimal(18,4)`` from the source tables on, so every sum and comparison of them is exact.

Branch B's group quantities are computed by partial aggregates over the joined rows, which are written once first, rather
than by a window partitioned by the group. The reference leaves ties in the first-row order arbitrary; here they are
broken by the remaining columns, largest first, and exactly one of the rows that are equal in all of them is adjusted, as
``row_number() = 1`` would.

The final enrichment needs the work's structure code and journal date; both are carried from the
branch joins (work and journal keys are the ERP tables' primary keys), so the big tables are joined
once, not twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix import labels as L
from periodix.functions import is_false, is_true, nullif, strip_spaces
from periodix.operators.skew import join_per_key
from periodix.sources.work import fixed

T1_COLUMNS = ["object", "work_id", L.COL_WORK_KIND, L.COL_ENRP_TYPE, L.COL_SPIDER_RESOURCE,
              L.COL_RESOURCE_CODE, L.COL_FACT_HOURS, L.COL_NORM_HOURS, L.COL_NORMED, L.COL_RESOURCE]
_CARRIED = ["structure_unique_code", "zhfvr_date", "work_shift_name"]


def work_context(works: DataFrame, zhufvr: DataFrame, objects: DataFrame) -> DataFrame:
    """Works whose journal is not deleted and is done, with the mapped site (the branches' filter).

    The reference's left joins become inner joins through its WHERE clause; written so here.
    """
    journal = zhufvr.where(is_false("delete_flag") & is_true("is_done")).select(
        "link", "territory_value", "zhfvr_date", "work_shift_name")
    sites = objects.where(F.col("spider_name").isNotNull()).select(
        F.col("territory_value").alias("_tv"), F.col("spider_name").alias("object"))
    w = works.select("work_id", "zhufvr_id", "type_work_name", "enrp_type", "structure_unique_code")
    ctx = w.join(journal, F.col("zhufvr_id") == F.col("link"))
    ctx = ctx.join(sites, F.col("territory_value") == F.col("_tv"))
    return ctx.select("work_id", "object", "type_work_name", "enrp_type", *_CARRIED)


def _ownership(own_name: str) -> Column:
    name, analytics = F.col("contragent_name"), F.col("analytics_name")
    return (F.when(name == own_name, F.lit(L.OWN_RESOURCE))
            .when(name != own_name, F.lit(L.HIRED_RESOURCE))
            .when(analytics.like(L.HIRED_PREFIX_PATTERN), F.lit(L.HIRED_RESOURCE))
            .when(~analytics.like(L.HIRED_PREFIX_PATTERN), F.lit(L.OWN_RESOURCE)))


def _raw_rows(tw: DataFrame, own_name: str) -> DataFrame:
    """The raw hours' columns that the branches use, the ownership worked out, so that names need not be shuffled."""
    return tw.select("work_id", "analytics_value", "res_name", "res_code", "hours", _ownership(own_name).alias("_owner"))


def _raw_branch(raw: DataFrame, ctx: DataFrame, normed: Column) -> DataFrame:
    joined = raw.select("work_id", "res_name", "res_code", "hours", "_owner", normed.alias("_normed")).join(ctx, "work_id")
    hours = F.col("hours")
    return joined.select(
        "object", "work_id",
        F.col("type_work_name").alias(L.COL_WORK_KIND),
        F.col("enrp_type").alias(L.COL_ENRP_TYPE),
        F.col("res_name").alias(L.COL_SPIDER_RESOURCE),
        F.col("res_code").alias(L.COL_RESOURCE_CODE),
        hours.alias(L.COL_FACT_HOURS),
        F.when(hours != 0, hours).otherwise(_no_hours()).alias(L.COL_NORM_HOURS),
        F.col("_normed").alias(L.COL_NORMED),
        F.col("_owner").alias(L.COL_RESOURCE),
        *_CARRIED,
    )


def _no_hours() -> Column:
    return F.lit(0).cast(L.HOURS_TYPE)


def _countable(placeholders: Sequence[str]) -> Column:
    """The existence tests' extra condition: the analytics value is not a placeholder (null: false)."""
    return F.coalesce(~F.col("analytics_value").isin(*placeholders), F.lit(False))


_NORM_KEYS = ["work_id", "analytics_value"]


def norm_flags(tw: DataFrame, nw: DataFrame) -> DataFrame:
    """Raw hour rows with ``_has_norm`` and ``_has_zero_norm``: whether a norm row (with zero fact
    hours) exists for the same (work, analytics) -- SQL equality, so a null key part never matches.

    One pass serves both existence tests: the norm keys are grouped once (a partial aggregate), and the flags reach the
    rows through :func:`join_per_key`.
    """
    present = nw.dropna("any", subset=_NORM_KEYS).groupBy(*_NORM_KEYS).agg(
        F.lit(True).alias("_has_norm"), F.max(F.col("fact_workload") == 0).alias("_has_zero_norm"))
    flagged = join_per_key(tw, present, _NORM_KEYS, "left")
    return flagged.withColumns({
        "_has_norm": F.coalesce(F.col("_has_norm"), F.lit(False)),
        "_has_zero_norm": F.coalesce(F.col("_has_zero_norm"), F.lit(False)),
    })


def _with_norm(flagged: DataFrame, placeholders: Sequence[str]) -> tuple[Column, Column]:
    """Whether a flagged raw row belongs to branch A, and whether to branch C; no row belongs to both."""
    countable = _countable(placeholders)
    return ~(F.col("_has_norm") & countable), F.col("_has_zero_norm") & countable


def hours_unnormed(tw: DataFrame, nw: DataFrame, ctx: DataFrame, own_name: str,
                   placeholders: Sequence[str]) -> DataFrame:
    """Branch A: raw hours without a norm row (placeholder analytics always kept)."""
    flagged = norm_flags(_raw_rows(tw, own_name), nw)
    return _raw_branch(flagged.where(_with_norm(flagged, placeholders)[0]), ctx, F.lit(False))


def hours_zero(tw: DataFrame, nw: DataFrame, ctx: DataFrame, own_name: str,
               placeholders: Sequence[str]) -> DataFrame:
    """Branch C: raw hours that have a norm row with zero fact hours."""
    flagged = norm_flags(_raw_rows(tw, own_name), nw)
    return _raw_branch(flagged.where(_with_norm(flagged, placeholders)[1]), ctx, F.lit(True))


def hours_from_raw(tw: DataFrame, nw: DataFrame, ctx: DataFrame, own_name: str, placeholders: Sequence[str]) -> DataFrame:
    """Branches A and C together: the raw hours and the norm keys are each read once."""
    flagged = norm_flags(_raw_rows(tw, own_name), nw)
    unnormed, zero = _with_norm(flagged, placeholders)
    return _raw_branch(flagged.where(unnormed | zero), ctx, zero)


# group-first order of branch B: resource code descending with nulls first, then these columns,
# each largest first (the reference leaves this tie-break arbitrary)
B_TIE_BREAK = ["res_spider_name", "fact_workload", "norm_workload", "nt_res", "object", "raw_hours",
               "type_work_name", "enrp_type", "structure_unique_code", "zhfvr_date", "work_shift_name"]


def group_excess(rows: DataFrame, group: list[str], main_code: str) -> DataFrame:
    """(group, _first, _over): the number of the first row of each group that gives up its excess, and that excess.

    Sums are exact and maxima do not depend on order, so they are the same however rows are laid out. One hash aggregate
    over all rows finds the groups that may qualify: the largest code, a null being larger than any, is the main one, and
    the total exceeds the smallest raw hours. Only their main-worker rows are then ordered.
    """
    code = F.col("res_spider_code")
    total = rows.groupBy(*group).agg(
        F.sum("fact_workload").alias("_total"), F.min("raw_hours").alias("_least"),
        F.max(F.coalesce(code > main_code, F.lit(True)).cast("int")).alias("_above"))
    total = total.where((F.col("_above") == 0) & (F.col("_total") > F.col("_least") + 1)).drop("_above", "_least")
    first = F.struct(*B_TIE_BREAK, "_row")
    firsts = join_per_key(rows.where(code == main_code), total, group)
    firsts = firsts.groupBy(*group).agg(F.max(first).alias("first"), F.first("_total").alias("_total"))
    return firsts.where(F.col("_total") > F.col("first.raw_hours") + 1).select(
        *group, F.col("first._row").alias("_first"), (F.col("_total") - F.col("first.raw_hours")).alias("_over"))


def hours_normed(tw: DataFrame, nw: DataFrame, ctx: DataFrame, placeholders: Sequence[str],
                 main_code: str = L.MAIN_WORKER_CODE) -> DataFrame:
    """Branch B: norm rows with non-zero fact hours; main-worker excess removed from the group's first row.

    The joined rows are numbered and written once (:func:`periodix.sources.work.fixed`): the group quantities and the rows
    that they adjust are read from the same table, so the row taken as first is adjusted exactly once.
    """
    raw_hours = tw.select(F.col("work_id").alias("_tw_work"), F.col("analytics_value").alias("_tw_an"),
                          F.col("hours").alias("raw_hours"))
    rows = nw.where(F.col("fact_workload") != 0).join(ctx, "work_id")
    rows = rows.join(raw_hours, (F.col("work_id") == F.col("_tw_work")) & (F.col("analytics_value") == F.col("_tw_an")),
                     "left")
    group = ["work_id", "analytics_value"]
    rows = fixed(rows.select(*group, "res_spider_code", *B_TIE_BREAK, F.monotonically_increasing_id().alias("_row")), "hours-normed")
    # only main-worker rows give up an excess; the others are not shuffled again
    main = F.coalesce(F.col("res_spider_code") == main_code, F.lit(False))
    excess = group_excess(rows, group, main_code)
    marked = join_per_key(rows.where(main), excess, group, "left").unionByName(rows.where(~main), allowMissingColumns=True)
    fact = F.col("fact_workload")
    hours = (F.when(F.col("_row") == F.col("_first"), (fact - F.col("_over")).cast(L.HOURS_TYPE))
             .when(F.col("analytics_value").isin(*placeholders), _no_hours()).otherwise(fact))
    return marked.select(
        "object", "work_id",
        F.col("type_work_name").alias(L.COL_WORK_KIND),
        F.col("enrp_type").alias(L.COL_ENRP_TYPE),
        F.col("res_spider_name").alias(L.COL_SPIDER_RESOURCE),
        F.col("res_spider_code").alias(L.COL_RESOURCE_CODE),
        hours.alias(L.COL_FACT_HOURS),
        F.col("norm_workload").alias(L.COL_NORM_HOURS),
        F.lit(True).alias(L.COL_NORMED),
        F.when(is_false("nt_res"), F.lit(L.OWN_RESOURCE)).when(is_true("nt_res"), F.lit(L.HIRED_RESOURCE))
        .alias(L.COL_RESOURCE),
        *_CARRIED,
    )


def reconcile_hours(tw: DataFrame, nw: DataFrame, works: DataFrame, zhufvr: DataFrame, objects: DataFrame,
                    gandoper: DataFrame, positions: DataFrame, key_res: DataFrame, own_name: str,
                    placeholders: Sequence[str], project_type: str = L.PROJECT,
                    main_code: str = L.MAIN_WORKER_CODE) -> DataFrame:
    """The complete hours mart: the three branches, plan dimensions, contract position, key-resource flag."""
    ctx = work_context(works, zhufvr, objects)
    t1 = hours_from_raw(tw, nw, ctx, own_name, placeholders).unionByName(hours_normed(tw, nw, ctx, placeholders, main_code))
    plan = gandoper.where(F.col("project_type") == project_type).select(
        F.col("f_CodeIdent").alias("_g_code"), F.col("object").alias("_g_object"),
        "SNT_Knstr", "SNT_KnstrE", "Num_Con")
    vdc = positions.select(F.col(L.COL_CIPHER).alias("_v_cipher"), F.col("object").alias("_v_object"),
                           L.COL_POSITION)
    # the contract position is joined with the operations, so that the hours are shuffled once for both
    plan = plan.join(vdc, (F.col("Num_Con") == F.col("_v_cipher")) & (F.col("_g_object") == F.col("_v_object")), "left")
    plan = plan.drop("Num_Con", "_v_cipher", "_v_object")
    out = t1.join(plan, (strip_spaces("structure_unique_code") == F.col("_g_code"))
                  & (F.col("object") == F.col("_g_object")))
    keyres = key_res.select(F.col("f_opertype").alias("_k_type"), F.col("rescode").alias("_k_code"))
    out = out.join(keyres, (F.col(L.COL_ENRP_TYPE) == F.col("_k_type")) & (F.col(L.COL_RESOURCE_CODE) == F.col("_k_code")),
                   "left")
    structure = (F.when(F.col("SNT_Knstr") == L.EARTHWORK, F.lit(L.EARTHWORK))
                 .when(F.col("SNT_Knstr") == L.PAVEMENT, F.lit(L.PAVEMENT))
                 .otherwise(F.lit(L.OTHER_WORKS)))
    # decimals throughout: the quotient has 20 decimals, the percentage 16 before it is rounded to 2
    quotient = F.col(L.COL_FACT_HOURS) / nullif(L.COL_NORM_HOURS, 0)
    deviation = F.abs(F.round((quotient * 100 - 100).cast("decimal(38,16)"), 2)).cast("decimal(24,2)")
    return out.select(
        *T1_COLUMNS,
        "structure_unique_code",
        structure.alias(L.COL_STRUCTURE),
        F.col("SNT_KnstrE").alias(L.COL_STRUCTURE_ELEMENT),
        L.COL_POSITION,
        F.col("zhfvr_date").alias(L.COL_DATE),
        F.col("work_shift_name").alias(L.COL_SHIFT),
        F.year("zhfvr_date").alias(L.COL_YEAR),
        F.month("zhfvr_date").alias(L.COL_MONTH),
        deviation.alias(L.COL_DEVIATION),
        F.col("_k_code").isNotNull().alias(L.COL_KEY_RESOURCE),
    )
