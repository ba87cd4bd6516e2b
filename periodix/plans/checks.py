"""Data-quality checks. Each returns the violating rows; an empty result is a pass.

All are grouped aggregations (map-side partial aggregation, one shuffle of partial sums) or
aggregates joined on their group keys. Global totals are computed as one aggregate over a tagged
union of the inputs, so no join of one-row frames is needed. Money totals that are rounded or
compared are summed exactly, so the verdict does not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix import labels as L
from periodix.functions import concat_skip_nulls, round_half_even
from periodix.functions.sums import exact_sum
from periodix.operators.skew import existence_flags

SNAPSHOT_KEYS = ["object", "nz_year", "nz_month", "project_type"]
CHECK_COLUMNS = SNAPSHOT_KEYS + ["status"]


def _status_rows(grouped: DataFrame, status: Column) -> DataFrame:
    return grouped.withColumn("status", status).select(*CHECK_COLUMNS)


def slice_totals(gandoper: DataFrame) -> DataFrame:
    """Actual and planned project cost of each snapshot slice (Q1 and Q2), from one pass over the operations."""
    rows = gandoper.where(F.col("project_type").isin(L.SNAPSHOT_NZ, L.SNAPSHOT_OVNZ))
    return rows.groupBy(*SNAPSHOT_KEYS).agg(exact_sum(F.col("s_act_CC_SMRFull")).alias("fact"), exact_sum(F.col("s_pln_CC_SMRFull")).alias("plan"))


def fact_in_plan_slices(totals: DataFrame, exception: tuple[str, str, str] | None = None) -> DataFrame:
    """Q1 over :func:`slice_totals`."""
    out = _status_rows(totals.where((F.col("project_type") == L.SNAPSHOT_NZ) & (F.col("fact") != 0)), F.lit(L.STATUS_FACT_IN_NZ))
    if exception is not None:
        obj, year, month = exception
        out = out.where(~((F.col("object") == obj) & (F.col("nz_year") == year) & (F.col("nz_month") == month)
                          & (F.col("project_type") == L.SNAPSHOT_NZ)))
    return out


def plan_in_fact_slices(totals: DataFrame) -> DataFrame:
    """Q2 over :func:`slice_totals`."""
    return _status_rows(totals.where((F.col("project_type") == L.SNAPSHOT_OVNZ) & (F.col("plan") != 0)), F.lit(L.STATUS_PLAN_IN_OVNZ))


def check_fact_nz(gandoper: DataFrame, exception: tuple[str, str, str] | None = None) -> DataFrame:
    """Q1: actual project cost present in a plan-period (НЗ) snapshot.

    ``exception`` = (object, year, month) excluded on purpose. The reference's filter compares each
    part with ``!=`` and can never return a row; this is its intended form, ``NOT (all equal)``.
    """
    return fact_in_plan_slices(slice_totals(gandoper), exception)


def check_plan_ovnz(gandoper: DataFrame) -> DataFrame:
    """Q2: planned project cost present in a fact-period (ОВНЗ) snapshot."""
    return plan_in_fact_slices(slice_totals(gandoper))


def check_duplicate_projects(gandoper: DataFrame) -> DataFrame:
    """Q3: an operation code repeated within one site, period and project type."""
    # the reference's key is the period, the type and the code put together without nulls; within equal periods and types
    # that is the code alone, and a group's key takes half the room
    key = F.coalesce(F.col("Code"), F.lit(""))
    g = gandoper.groupBy(*SNAPSHOT_KEYS, key.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    status = F.when(F.col("_n") > 1, F.lit(L.STATUS_DUPLICATE)).otherwise(F.lit(""))
    return _status_rows(g, status).where(F.col("status") == L.STATUS_DUPLICATE)


def check_hours_total(tw: DataFrame, nw: DataFrame, threshold_pct: float = 0.1) -> DataFrame:
    """Q4: reconciled hours exceed the raw hour log by ``threshold_pct`` % or more (one-sided).

    The reconciled total is the reference test's own simplification: unnormed raw rows (no placeholder
    rule) plus all norm rows. Output: ``delta_hours`` (percent, 2 decimals) when violated.
    """
    # existence only (see existence_flags)
    unnormed = existence_flags(tw, nw, ["work_id", "analytics_value"]).where(~F.col("_exists"))
    hours = lambda name: F.col(name).cast(L.HOURS_TYPE)
    null = F.lit(None).cast(L.HOURS_TYPE)
    tagged = (unnormed.select(hours("hours").alias("_mart"), null.alias("_raw"))
              .unionByName(nw.select(hours("fact_workload").alias("_mart"), null.alias("_raw")))
              .unionByName(tw.select(null.alias("_mart"), hours("hours").alias("_raw"))))
    totals = tagged.agg(F.sum("_mart").alias("hours_from_mart"), F.sum("_raw").alias("hours_from_tchnq_wrkrs"))
    raw = F.col("hours_from_tchnq_wrkrs")
    # both totals are exact; their ratio keeps at least ten decimals
    share = ((F.col("hours_from_mart") - raw) / F.when(raw != 0, raw)).cast("decimal(38,12)")
    delta = F.round((share * 100).cast("decimal(38,10)"), 2).cast("decimal(30,2)")
    return totals.select(delta.alias("delta_hours")).where(F.col("delta_hours") >= threshold_pct)


def _per_operation(df: DataFrame, code: str, ss: str, sp: str) -> DataFrame:
    both = F.coalesce(F.col(ss), F.lit(0.0)) + F.coalesce(F.col(sp), F.lit(0.0))
    rows = df.where(F.col(ss).isNotNull() | F.col(sp).isNotNull()).select("object", F.col(code).alias("_code"), both.alias("_both"))
    return rows.groupBy("_code", "object").agg(exact_sum(F.col("_both")).alias("_total"))  # the order of the mart's buckets


def check_oper_duplication(gandoper: DataFrame, archive: DataFrame, mart: DataFrame,
                           tolerance: float = 1.0) -> DataFrame:
    """Q5: per-operation plan and fact totals in the mart differ from the raw tables by more than 1.

    Output as in the reference: the number of offending operations, once per side that has any
    (``union`` drops an equal second count).
    """
    raw_plan = _per_operation(gandoper.where(F.col("project_type") == L.PROJECT), "Code", "c_pln_SMRSsI", "c_pln_SMRSpI")
    raw_fact = _per_operation(archive.where((F.col("project_type") == L.PROJECT) & F.col("ResCode").isNull()),
                              "OperCode", "c_aac_SMRSsI", "c_aac_SMRSpI")

    def mart_side(kind: str) -> DataFrame:
        return _per_operation(mart.where(F.col("smr_type") == kind), "code", "smr_ss", "smr_sp") \
            .withColumnRenamed("_total", "_mart")

    def offending(raw: DataFrame, kind: str) -> DataFrame:
        j = raw.join(mart_side(kind), ["_code", "object"])
        n = j.where(F.abs(F.col("_total") - F.col("_mart")) > tolerance).agg(F.count(F.lit(1)).alias("count"))
        return n.where(F.col("count") > 0)

    return offending(raw_plan, L.PLAN).union(offending(raw_fact, L.FACT)).distinct()


def check_grand_total(gandoper: DataFrame, archive: DataFrame, mart: DataFrame,
                      tolerance: float = 10000.0) -> DataFrame:
    """Q6: the mart's grand total differs from the raw plan + fact totals by more than ``tolerance``.

    The two totals are reported in cents."""
    null = F.lit(None).cast("double")
    cols = ["_a_ss", "_a_sp", "_g_ss", "_g_sp", "_m_sp", "_m_ss"]

    def totals(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
        sums = df.select(*[F.col(c).cast("double").alias(n) for n, c in mapping.items()]).agg(*[exact_sum(F.col(n)).alias(n) for n in mapping])
        return sums.select(*[F.col(c) if c in mapping else null.alias(c) for c in cols])

    # each table's own two measures are added up over its rows; the union holds one row for each table
    tagged = (totals(archive.where(F.col("project_type") == L.PROJECT), {"_a_ss": "c_aac_SMRSsI", "_a_sp": "c_aac_SMRSpI"})
              .unionByName(totals(gandoper.where(F.col("project_type") == L.PROJECT),
                                  {"_g_ss": "c_pln_SMRSsI", "_g_sp": "c_pln_SMRSpI"}))
              .unionByName(totals(mart, {"_m_sp": "smr_sp", "_m_ss": "smr_ss"})))
    t = tagged.agg(*[F.max(c).alias(c) for c in cols])
    raw_total = (F.col("_g_ss") + F.col("_g_sp")) + (F.col("_a_ss") + F.col("_a_sp"))
    fin_total = F.col("_m_sp") + F.col("_m_ss")
    return t.where(F.abs(raw_total - fin_total) > tolerance).select(
        F.round(fin_total, 2).alias("fin_total_smr"), F.round(raw_total, 2).alias("raw_total"))


def check_cost_components(gandoper: DataFrame, cost: DataFrame, excluded_object: str | None = None,
                          unit: float = 10000.0) -> DataFrame:
    """Q7: operation totals and cost-component totals disagree in units of ``unit`` for both fact and plan.

    Joined on the reference's concatenated period key (null parts skipped).
    """
    link = concat_skip_nulls("object", "nz_year", "nz_month", "project_type")
    sides = {f"{side}_{part}": f"s_{side}_CC_{part}" for side in ("act", "pln") for part in ("SMRSsI", "SMRSpI")}
    rows = gandoper.select(*SNAPSHOT_KEYS, link.alias("_link"), *[F.coalesce(F.col(c), F.lit(0.0)).alias(n) for n, c in sides.items()])
    ops = rows.groupBy(*SNAPSHOT_KEYS, "_link").agg(
        (exact_sum(F.col("act_SMRSsI")) + exact_sum(F.col("act_SMRSpI"))).alias("_fact"),
        (exact_sum(F.col("pln_SMRSsI")) + exact_sum(F.col("pln_SMRSpI"))).alias("_plan"))
    comps = cost.where((F.col("Code") == "SMRSsI") | (F.col("Code") == "SMRSpI")).groupBy(link.alias("_link")).agg(
        exact_sum(F.col("f_act_Total")).alias("_total_fact"), exact_sum(F.col("f_pln_Total")).alias("_total_plan"))
    j = ops.join(comps, "_link")
    r = lambda c: round_half_even(F.col(c) / unit)
    status = (F.when(r("_fact") == r("_total_fact"), F.lit(""))
              .when(r("_plan") == r("_total_plan"), F.lit(""))
              .otherwise(F.lit(L.STATUS_ERROR)))
    out = _status_rows(j, status).where(F.col("status") == L.STATUS_ERROR)
    if excluded_object is not None:
        out = out.where(F.col("object") != excluded_object)
    return out


def check_contract_total(gandoper: DataFrame, vdc: DataFrame, max_pct: float = 10.0) -> DataFrame:
    """Q8: a site's project total differs from its contract total by more than ``max_pct`` %.

    Money is rounded as numeric (to 2 decimals, half away from zero); a site with no contract gives a
    null ratio and passes, as in the reference.
    """
    amount = (F.coalesce(F.col("s_act_CC_SMRFull"), F.lit(0.0)) + F.coalesce(F.col("s_pln_CC_SMRFull"), F.lit(0.0)))
    sp = gandoper.where(F.col("project_type") == L.PROJECT).groupBy("object").agg(
        F.sum(F.round(amount.cast("decimal(38,10)"), 2)).alias("_sp"))
    contract = vdc.groupBy(F.col("object").alias("_v_object")).agg(
        F.round(F.sum(F.col(L.COL_CONTRACT_SMR).cast("decimal(38,10)")), 2).alias("_vdc"))
    j = sp.join(contract, F.col("object") == F.col("_v_object"), "left")
    s, v = F.col("_sp").cast("double"), F.col("_vdc").cast("double")
    pct = F.round((s / F.when(v != 0, v) - 1) * 100, 3)
    return j.select("object", s.alias("sum_smr_sp"), v.alias("sum_smr_vdc"), (s - v).alias("delta"),
                    pct.alias("%_delta")).where(F.abs(F.col("%_delta")) > max_pct)


def check_position_unique(positions: DataFrame, key: str = "unique_test") -> DataFrame:
    """Q9: contract position keys that occur more than once."""
    return (positions.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def check_position_not_null(positions: DataFrame, parts: Sequence[str] = (L.COL_CIPHER, "object")) -> DataFrame:
    """Q10: positions whose key is incomplete.

    The key is built with a null-skipping concatenation and is never null, so the reference's
    ``not_null`` test cannot fail; its parts are checked instead.
    """
    cond = F.col(parts[0]).isNull()
    for p in parts[1:]:
        cond = cond | F.col(p).isNull()
    return positions.where(cond).select(*parts, "unique_test")


def check_report(checks: dict[str, DataFrame], sample: int = 5) -> list[dict]:
    """For printing: per check its name, violation count and up to ``sample`` offending rows. The full tables of
    violations are written by the build."""
    report = []
    for name, df in checks.items():
        n = df.count()
        rows = [r.asDict() for r in df.limit(sample).collect()] if n else []
        report.append({"check": name, "violations": n, "sample": rows})
    return report
