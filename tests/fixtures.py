"""Builders for small reference-shaped frames (all unspecified columns null)."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from periodix import labels as L

TS = T.TimestampNTZType()
D = T.DoubleType()
H = T.DecimalType(18, 4)
S = T.StringType()

GANDOPER = [("index", T.LongType()), ("Code", S), ("f_CodeIdent", S), ("DurPlanD", D), ("Start", TS), ("Fin", TS),
            ("VolPlan", D), ("project_type", S), ("object", S), ("Calen", S), ("nz_year", S), ("nz_month", S),
            ("c_pln_SMRSsI", D), ("c_pln_SMRSpI", D), *[(f"c_pln_{p}", D) for p in L.COST_PARTS],
            ("c_pln_UslGpd", D), ("c_act_AmLiz", D), ("c_act_RepMiM", D), ("c_act_FuelMiM", D), ("c_act_FnOpTr", D),
            ("s_act_CC_SMRFull", D), ("s_pln_CC_SMRFull", D), ("s_act_CC_SMRSsI", D), ("s_act_CC_SMRSpI", D),
            ("s_pln_CC_SMRSsI", D), ("s_pln_CC_SMRSpI", D), ("WorkLoadFact", D), ("Name", S), ("Ispol", S),
            ("IspolUch", S), ("Real", S), ("SNT_Knstr", S), ("SNT_KnstrE", S), ("SNT_TypeKnstrE", S),
            ("SNT_Obj", S), ("Num_Con", S)]

ARCHIVE = [("index", T.LongType()), ("OperCode", S), ("ResCode", S), ("Start", TS), ("Fin", TS), ("Vol", D),
           ("project_type", S), ("object", S), ("c_aac_SMRSsI", D), ("c_aac_SMRSpI", D), ("c_aac_UslGpd", D),
           *[(f"c_aac_{p}", D) for p in L.COST_PARTS], ("WorkLoadFact", D)]

VDC = [(L.COL_WORK_NAME, S), (L.COL_CIPHER, S), (L.COL_CONTRACT_SMR, D), ("object", S), (L.COL_VOLUME, D),
       (L.COL_UNITS, S), (L.COL_UNIT_PRICE, D)]

TW = [("work_id", S), ("analytics_value", S), ("analytics_name", S), ("contragent_name", S),
      ("contragent_value", S), ("res_name", S), ("res_code", S), ("hours", H)]
NW = [("work_id", S), ("analytics_value", S), ("res_spider_name", S), ("res_spider_code", S),
      ("fact_workload", H), ("norm_workload", H), ("nt_res", T.BooleanType())]
WORKS = [("work_id", S), ("zhufvr_id", S), ("type_work_name", S), ("enrp_type", S), ("structure_unique_code", S),
         ("structure_works_code", S), ("structure_is_delete", T.BooleanType())]
ZHUFVR = [("link", S), ("territory_value", S), ("zhfvr_date", TS), ("work_shift_name", S),
          ("delete_flag", T.BooleanType()), ("is_done", T.BooleanType())]
OBJECTS = [("territory_value", S), ("spider_name", S)]


def ts(s: str | None):
    return None if s is None else datetime.fromisoformat(s)


def frame(spark, fields, rows: list[dict]):
    """DataFrame with the given (name, type) fields; each row dict fills some of them."""
    names = [n for n, _ in fields]
    unknown = {k for r in rows for k in r} - set(names)
    assert not unknown, unknown
    schema = T.StructType([T.StructField(n, t, True) for n, t in fields])
    def value(r, n, t):
        v = r.get(n)
        return Decimal(str(v)) if t is H and v is not None else v
    return spark.createDataFrame([tuple(value(r, n, t) for n, t in fields) for r in rows], schema)
