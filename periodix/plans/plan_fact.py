"""Plan and fact spread by month, and the plan/fact mart.

The reference rejoins the month parts to the raw rows on (index, code, project type). With duplicate
keys that join pairs every part with every raw row of the key. Here the pairing is never built: the
sum over pairs of ``weight x measure`` equals ``(sum of weights) x (sum of measures)``, so weights are
summed per (key, month) and measures per (key, row or site) first, each by partial aggregation, and
only those sums are joined. With unique keys (the caller says so) measures ride along the explode and
the plan spread is a single narrow stage.

An operation's months repeat all that is known of it, so they are the last thing the mart makes: it can take both spreads
as :class:`OperationRows`, whose months are laid out behind its joins and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix import labels as L
from periodix.functions import round_half_even, zero_pad_month
from periodix.functions.sums import exact_sum
from periodix.operators.plan_start import plan_start
from periodix.operators.skew import join_per_key
from periodix.operators.spread import key_steps, lay_out_steps, month_parts, month_weights

PLAN_FACT_COLUMNS = ["code", "start_year", "start_month", "smr_ss", "smr_sp", "object", "smr_type",
                     "ZATRATY", "PRIBYL", "SMRFull", "UslGpd"]


@dataclass(frozen=True)
class OperationRows:
    """Plan or fact rows whose months are not laid out: one row for an operation, or for an execution key and site."""

    rows: DataFrame
    lay_out: Callable[[DataFrame, list[str]], DataFrame]

    def months(self, rows: DataFrame | None = None) -> DataFrame:
        """The months of :attr:`rows`, or of what a join has made of them; columns that it has added are carried."""
        rows = self.rows if rows is None else rows
        return self.lay_out(rows, [c for c in rows.columns if c not in self.rows.columns])


def _own_terms(prefix: str) -> dict[str, Column]:
    """The measure expressions of a row that the others follow from."""
    def c(name: str) -> Column:
        return F.coalesce(F.col(f"{prefix}{name}"), F.lit(0.0))

    costs = -c(L.COST_PARTS[0])
    for part in L.COST_PARTS[1:]:
        costs = costs - c(part)
    return {"smr_ss": F.col(f"{prefix}SMRSsI"), "smr_sp": F.col(f"{prefix}SMRSpI"), "ZATRATY": costs, "UslGpd": c("UslGpd")}


def _measure_terms(own: dict[str, Column]) -> dict[str, Column]:
    """Per-row measure expressions of the reference (before weighting)."""
    ss, sp = (F.coalesce(own[n], F.lit(0.0)) for n in ("smr_ss", "smr_sp"))
    return {
        "smr_ss": own["smr_ss"],
        "smr_sp": own["smr_sp"],
        "SMRFull": ss + sp,
        "ZATRATY": own["ZATRATY"],
        "PRIBYL": own["ZATRATY"] + sp + ss + own["UslGpd"],
        "UslGpd": own["UslGpd"],
    }


_ROUNDED = ("SMRFull", "ZATRATY", "PRIBYL", "UslGpd")


def _weighted(weight: Column, terms: dict[str, Column]) -> list[Column]:
    out = []
    for name, term in terms.items():
        value = weight * term
        out.append((round_half_even(value) if name in _ROUNDED else value).alias(name))
    return out


def plan_by_month(gandoper: DataFrame, unique_key: bool = False, project_type: str = L.PROJECT,
                  laid_out: bool = True) -> DataFrame | OperationRows:
    """Planned measures per operation and calendar month.

    Output: gant_index, code, start_year, start_month, smr_type, object, smr_ss, smr_sp, SMRFull,
    ZATRATY, PRIBYL, UslGpd; the four rounded measures are rounded per row, ties to even.

    ``unique_key=True``: one project row per (index, Code); no shuffle. Otherwise one row per
    (operation row, month) carrying the total weight of its key's parts in that month.
    ``laid_out=False`` gives :class:`OperationRows`; without unique keys their rows are months already.
    """
    keys = ["gant_index", "code"]
    own = _own_terms("c_pln_")
    measures = [t.alias(n) for n, t in own.items()]
    if unique_key:
        measure_cols = ["c_pln_SMRSsI", "c_pln_SMRSpI", "c_pln_UslGpd"] + [f"c_pln_{p}" for p in L.COST_PARTS]
        rows = plan_start(gandoper, project_type, carry=measure_cols).select(*keys, "object", "start_date", "end_date", *measures)
    else:
        weights = month_weights(plan_start(gandoper, project_type), keys, "start_date", "end_date")
        raw = gandoper.where(F.col("project_type") == project_type).select(
            F.col("index").alias("gant_index"), F.col("Code").alias("code"), "object", *measures)
        # months-per-key weights joined to every raw row of the key
        rows = join_per_key(raw, weights, keys)

    def lay_out(rows: DataFrame, more: list[str]) -> DataFrame:
        if unique_key:
            rows = month_parts(rows, keys, "start_date", "end_date", carry=["object", *own, *more], unique_key=True)
        return rows.select(
            "gant_index", "code", "start_year", "start_month",
            F.lit(L.PLAN).alias("smr_type"),
            "object",
            *_weighted(F.col("weight"), _measure_terms({n: F.col(n) for n in own})),
            *more,
        )

    spread = OperationRows(rows, lay_out)
    return spread.months() if laid_out else spread


def fact_by_month(archive: DataFrame, project_type: str = L.PROJECT, laid_out: bool = True) -> DataFrame | OperationRows:
    """Actual measures per execution key, calendar month and site.

    Month parts come from operation-level rows (null ``ResCode``); the measures are summed over *all*
    archive rows of the key and site, as the reference's join back checks only index, code and
    project type. Keys with only null-start parts are dropped, as are null keys.
    ``laid_out=False`` gives :class:`OperationRows`, one for a key and site.
    """
    keys = ["archive_index", "code"]
    rows = archive.where(F.col("project_type") == project_type)
    ops = rows.where(F.col("ResCode").isNull()).select(
        F.col("index").alias("archive_index"), F.col("OperCode").alias("code"),
        F.col("Start").alias("start_date"), F.col("Fin").alias("end_date"))

    terms = _measure_terms(_own_terms("c_aac_"))
    measures = rows.select(F.col("index").alias("archive_index"), F.col("OperCode").alias("code"), "object",
                           *[t.alias(n) for n, t in terms.items()])
    sums = measures.groupBy("archive_index", "code", "object").agg(*[exact_sum(F.col(n)).alias(n) for n in terms])

    def lay_out(rows: DataFrame, more: list[str]) -> DataFrame:
        months = lay_out_steps(rows, [*keys, "object", *terms, *more]).where(F.col("weight").isNotNull())
        return months.select(
            # 128 bits of the row's key: distinct for any realistic number of rows, unlike a 64-bit hash
            F.md5(F.to_json(F.struct("archive_index", "code", "start_year", "start_month", "object"))).alias("id"),
            "archive_index", "code", "start_year", "start_month",
            F.lit(L.FACT).alias("smr_type"),
            *[(F.col("weight") * F.col(n)).alias(n) for n in ("smr_ss", "smr_sp")],
            "object",
            *[round_half_even(F.col("weight") * F.col(n)).alias(n) for n in _ROUNDED],
            *more,
        )

    # a weighted measure is null where its sum is, or the weight: of a key without any of these, no month is laid out
    some = F.col("ZATRATY").isNotNull() | F.col("PRIBYL").isNotNull() | F.col("SMRFull").isNotNull()
    spread = OperationRows(key_steps(ops, keys, "start_date", "end_date").join(sums.where(some), on=keys), lay_out)
    return spread.months() if laid_out else spread


def plan_fact_mart(plan: DataFrame | OperationRows, fact: DataFrame | OperationRows, gandoper: DataFrame, positions: DataFrame,
                   project_type: str = L.PROJECT) -> DataFrame:
    """The plan/fact mart: plan and fact rows with operation and contract dimensions."""
    g = gandoper.where(F.col("project_type") == project_type).select(
        F.col("Code").alias("_g_code"), F.col("object").alias("_g_object"),
        "Name", "Ispol", "IspolUch", "Real", "SNT_Knstr", "SNT_KnstrE", "SNT_TypeKnstrE", "SNT_Obj", "Num_Con")
    vdc = positions.select(
        F.col(L.COL_CIPHER).alias("_v_cipher"), F.col("object").alias("_v_object"),
        L.COL_WORK_NAME, L.COL_POSITION, L.COL_CONTRACT_SMR)
    delivery = None
    for source, label in L.DELIVERY_MODE_MAP.items():
        cond = F.col("Real") == source
        delivery = F.when(cond, F.lit(label)) if delivery is None else delivery.when(cond, F.lit(label))
    structure = (F.when(F.col("SNT_Knstr") == L.EARTHWORK, F.lit(L.EARTHWORK))
                 .when(F.col("SNT_Knstr") == L.PAVEMENT, F.lit(L.PAVEMENT))
                 .otherwise(F.lit(L.OTHER_WORKS)))
    # an operation's dimensions, contract position included, are put together once; plan and fact then join them on
    # (code, object) each for itself, so a side that lies bucketed by these keys stays where it is; the smaller side is
    # hashed, the dimensions or rows of operations, so months need not be sorted; labels are longer than what they stand
    # for, so they are set behind the join, but before months are laid out
    dims = g.join(vdc, (F.col("Num_Con") == F.col("_v_cipher")) & (F.col("_g_object") == F.col("_v_object")), "left")
    dims = dims.drop("_v_cipher", "_v_object")
    same = (F.col("code") == F.col("_g_code")) & (F.col("object") == F.col("_g_object"))

    def enriched(side: DataFrame | OperationRows) -> DataFrame:
        if isinstance(side, OperationRows):
            rows = side.rows.hint("shuffle_hash").join(dims, same)
        else:
            rows = side.select(*PLAN_FACT_COLUMNS).join(dims.hint("shuffle_hash"), same)
        rows = rows.withColumns({L.COL_DELIVERY_MODE: delivery, L.COL_STRUCTURE: structure})
        rows = rows.drop("_g_code", "_g_object", "Real")
        return side.months(rows) if isinstance(side, OperationRows) else rows

    columns = [
        *PLAN_FACT_COLUMNS,
        zero_pad_month(F.col("start_month")).alias("s_month"),
        "Name", "Ispol", "IspolUch",
        L.COL_DELIVERY_MODE,
        "SNT_Knstr", "SNT_KnstrE", "SNT_TypeKnstrE", "SNT_Obj", "Num_Con",
        L.COL_STRUCTURE,
        L.COL_WORK_NAME, L.COL_POSITION, L.COL_CONTRACT_SMR,
    ]
    return enriched(plan).select(*columns).unionByName(enriched(fact).select(*columns))
