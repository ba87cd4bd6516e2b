"""Reading the source tables of a real deployment (exports of the planning system, ERP and
dictionaries) with canonical column types.

Each table is read as parquet and its columns cast to the types the jobs expect. A missing column is an error, but for
the few descriptive ones in ``OPTIONAL``, which are then typed nulls. The projection is plain ``select`` + ``cast``, so
column pruning and filters still reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodix import labels as L

_COSTS_PLN = [(f"c_pln_{p}", "double") for p in L.COST_PARTS]
_COSTS_AAC = [(f"c_aac_{p}", "double") for p in L.COST_PARTS]

# canonical columns per source table (types inferred from use, as in the reference nothing is declared)
RAW_SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "raw_spider__gandoper": [
        ("index", "bigint"), ("Code", "string"), ("f_CodeIdent", "string"), ("DurPlanD", "double"),
        ("Start", "timestamp_ntz"), ("Fin", "timestamp_ntz"), ("VolPlan", "double"), ("project_type", "string"),
        ("object", "string"), ("Calen", "string"), ("nz_year", "string"), ("nz_month", "string"),
        ("c_pln_SMRSsI", "double"), ("c_pln_SMRSpI", "double"), *_COSTS_PLN, ("c_pln_UslGpd", "double"),
        ("c_act_AmLiz", "double"), ("c_act_RepMiM", "double"), ("c_act_FuelMiM", "double"),
        ("c_act_FnOpTr", "double"), ("s_act_CC_SMRFull", "double"), ("s_pln_CC_SMRFull", "double"),
        ("s_act_CC_SMRSsI", "double"), ("s_act_CC_SMRSpI", "double"), ("s_pln_CC_SMRSsI", "double"),
        ("s_pln_CC_SMRSpI", "double"), ("WorkLoadFact", "double"), ("Name", "string"), ("Ispol", "string"),
        ("IspolUch", "string"), ("Real", "string"), ("SNT_Knstr", "string"), ("SNT_KnstrE", "string"),
        ("SNT_TypeKnstrE", "string"), ("SNT_Obj", "string"), ("Num_Con", "string"),
    ],
    "raw_spider__archive": [
        ("index", "bigint"), ("OperCode", "string"), ("ResCode", "string"), ("Start", "timestamp_ntz"),
        ("Fin", "timestamp_ntz"), ("Vol", "double"), ("project_type", "string"), ("object", "string"),
        ("c_aac_SMRSsI", "double"), ("c_aac_SMRSpI", "double"), ("c_aac_UslGpd", "double"), *_COSTS_AAC,
        ("WorkLoadFact", "double"),
    ],
    "raw_spider__cost": [
        ("object", "string"), ("nz_year", "string"), ("nz_month", "string"), ("project_type", "string"),
        ("Code", "string"), ("f_act_Total", "double"), ("f_pln_Total", "double"),
    ],
    "raw_spider__calen_except": [
        ("Calen_Code", "string"), ("Start", "timestamp_ntz"), ("Fin", "timestamp_ntz"),
        ("Start_true", "timestamp_ntz"), ("Fin_true", "timestamp_ntz"),
    ],
    "raw__vdc_by_objects": [
        (L.COL_WORK_NAME, "string"), (L.COL_CIPHER, "string"), (L.COL_CONTRACT_SMR, "double"),
        ("object", "string"), (L.COL_VOLUME, "double"), (L.COL_UNITS, "string"), (L.COL_UNIT_PRICE, "double"),
    ],
    "1_c__technique_workers": [
        ("work_id", "string"), ("analytics_value", "string"), ("analytics_name", "string"),
        ("contragent_name", "string"), ("contragent_value", "string"), ("res_name", "string"),
        ("res_code", "string"), ("hours", L.HOURS_TYPE),
    ],
    "1_c__norm_workload": [
        ("work_id", "string"), ("analytics_value", "string"), ("res_spider_name", "string"),
        ("res_spider_code", "string"), ("fact_workload", L.HOURS_TYPE), ("norm_workload", L.HOURS_TYPE),
        ("nt_res", "boolean"),
    ],
    "1_c__works": [
        ("work_id", "string"), ("zhufvr_id", "string"), ("type_work_name", "string"), ("enrp_type", "string"),
        ("structure_unique_code", "string"), ("structure_works_code", "string"),
        ("structure_is_delete", "boolean"),
    ],
    "1_c__zhufvr": [
        ("link", "string"), ("territory_value", "string"), ("zhfvr_date", "timestamp_ntz"),
        ("work_shift_name", "string"), ("delete_flag", "boolean"), ("is_done", "boolean"),
    ],
    "dict__1c_objects_to_spider": [("territory_value", "string"), ("spider_name", "string")],
    "dict__spider_key_res": [("f_opertype", "string"), ("rescode", "string")],
    "dict__spider_kol_ekip": [("Code", "string"), ("Kol_Ekip", "double")],
    "dict__fot": [("res", "string"), ("start", "timestamp_ntz"), ("finish", "timestamp_ntz"), ("fot", "double")],
    "dict__mim": [
        ("res", "string"), ("object", "string"), ("start", "timestamp_ntz"), ("finish", "timestamp_ntz"),
        ("leasing", "double"), ("repair", "double"), ("fuel", "double"),
    ],
}

# attribute names used by the jobs (see periodix.plans.build.Sources)
SOURCE_ATTRS = {
    "raw_spider__gandoper": "gandoper", "raw_spider__archive": "archive", "raw_spider__cost": "cost",
    "raw__vdc_by_objects": "vdc", "1_c__technique_workers": "technique_workers",
    "1_c__norm_workload": "norm_workload", "1_c__works": "works", "1_c__zhufvr": "zhufvr",
    "dict__1c_objects_to_spider": "objects", "dict__spider_key_res": "key_res",
    "dict__spider_kol_ekip": "kol_ekip", "dict__fot": "fot", "dict__mim": "mim",
    "raw_spider__calen_except": "calen_except",
}

#: Columns that only describe a row: no filter, join or measure reads them.
OPTIONAL = {"raw_spider__gandoper": {"Ispol", "IspolUch", "SNT_TypeKnstrE", "SNT_Obj"}}


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the canonical columns of table ``name``, cast; raises if a column that is not optional is absent."""
    present = set(df.columns)
    missing = [c for c, _ in RAW_SCHEMAS[name] if c not in present and c not in OPTIONAL.get(name, ())]
    if missing:
        raise ValueError(f"{name} lacks required columns: {', '.join(missing)}")
    return df.select(*[(F.col(f"`{c}`").cast(t) if c in present else F.lit(None).cast(t)).alias(c)
                       for c, t in RAW_SCHEMAS[name]])


def read_raw(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Source table ``name`` from ``<base>/<name>`` (parquet), conformed to its canonical columns."""
    return conform(spark.read.parquet(base.rstrip("/") + "/" + name), name)


def raw_sources(spark: SparkSession, base: str):
    """All sources the build needs, read from ``base``, as :class:`periodix.plans.build.Sources`."""
    from periodix.plans.build import Sources

    return Sources(**{attr: read_raw(spark, base, name) for name, attr in SOURCE_ATTRS.items()})
