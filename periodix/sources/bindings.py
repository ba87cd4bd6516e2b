"""The reference's source tables, derived by Spark from the driver's TPC-H-style tables.

The reference reads planning-system exports (operations, execution archive, cost components), ERP
work logs (hours, norms, works, shift journal) and dictionaries. The driver ships orders, line items,
customers and nations instead. This module binds one to the other, so that every job runs over whole
driver tables and its work grows with them:

=========================  ==========================================================================
reference table            derived from
=========================  ==========================================================================
raw_spider__gandoper       one project row per order (end = order date, planned days = price / 1000,
                           site = customer nation) plus one snapshot row per line item
raw_spider__archive        one row per line item: order date .. ship date; flag 'N' rows are the
                           operation-level rows (null resource code), the others resource rows
raw_spider__cost           one cost-component row per line item
raw__vdc_by_objects        one contract position per customer, site = its nation
1_c__works / 1_c__zhufvr   one work and one shift-journal entry per order (date = order date)
1_c__technique_workers     line items with flag <> 'A', summed per (order, supplier)
1_c__norm_workload         line items with flag <> 'N', one norm row each
dict__1c_objects_to_spider nations; region 0 unmapped
dict__fot / dict__mim      rate per (resource, quarter; valid the quarter's first two months) /
                           (resource, site, quarter; valid four months, overlapping) from line items
dict__spider_kol_ekip      crew size per resource code from line items
=========================  ==========================================================================

Every frame is lazy; the jobs' column pruning and filters reach the parquet scans. The joins here
(line item -> order -> customer -> nation) are equi-joins on keys; Spark chooses broadcast only for
sides measured under ``spark.sql.autoBroadcastJoinThreshold`` (the 25-row nation table), else a
shuffle join, and adaptive execution splits skewed join partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodix import labels as L
from periodix.sources.tables import Tables


@dataclass(frozen=True)
class BindingParams:
    """Values the binding invents for the reference's literals (its GUIDs and company name)."""

    own_contractor_name: str = "Own Contractor LLC"
    own_contractor_value: str = "C-OWN"
    hired_contractor_prefix: str = "Contractor "
    # line items of these suppliers carry the "machine not found" placeholder analytics
    placeholder_analytics: tuple[str, ...] = ("S1", "S2")
    main_worker_analytics: str = "S3"
    key_resources: tuple[tuple[str, str], ...] = (("O", "Mont"), ("F", "RC-R"), ("P", "RC-N"))
    calendar_exceptions: tuple[tuple[str, str, str, str, str], ...] = field(default=(
        # Calen_Code, Start, Fin, Start_true, Fin_true
        ("SR_10", "1996-05-01 00:00:00", "1996-05-10 00:00:00", "1996-04-30 00:00:00", "1996-05-11 00:00:00"),
        ("SR_20", "1997-07-03 00:00:00", "1997-07-20 00:00:00", "1997-07-02 00:00:00", "1997-07-21 00:00:00"),
        ("STD", "1998-03-05 00:00:00", "1998-03-12 00:00:00", "1998-03-04 00:00:00", "1998-03-13 00:00:00"),
        ("STD", "1999-11-01 00:00:00", "1999-11-03 12:00:00", "1999-10-31 00:00:00", "1999-11-04 00:00:00"),
    ))


def op_code(orderkey: Column, priority: Column) -> Column:
    """Operation code; urgent orders carry the planning system's 'Kzn_' prefix."""
    return F.when(priority == "1-URGENT", F.concat(F.lit("Kzn_OP-"), orderkey.cast("string"))).otherwise(
        F.concat(F.lit("OP-"), orderkey.cast("string")))


def snapshot_type(linestatus: Column) -> Column:
    return F.when(linestatus == "F", F.lit(L.SNAPSHOT_NZ)).otherwise(F.lit(L.SNAPSHOT_OVNZ))


def rus_month(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in L.RUS_MONTHS]), F.month(ts))


def hours_of(x: Column) -> Column:
    """A number of hours, exact to four decimals."""
    return x.cast(L.HOURS_TYPE)


def _null(dtype: str = "double") -> Column:
    return F.lit(None).cast(dtype)


class World:
    """Reference-shaped source frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: BindingParams | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self.params = params or BindingParams()

    # -- shared joins -------------------------------------------------------------------------------
    @cached_property
    def orders_x(self) -> DataFrame:
        """Orders with their customer's columns and nation name."""
        c = self.t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        n = self.t.nation.select("n_nationkey", "n_name")
        return (self.t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"))
                .join(n, F.col("c_nationkey") == F.col("n_nationkey")))

    @cached_property
    def lineitem_x(self) -> DataFrame:
        """Line items with their order's date, priority and site."""
        o = self.orders_x.select("o_orderkey", "o_orderdate", "o_orderpriority", "n_name")
        return self.t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))

    # -- planning system ---------------------------------------------------------------------------
    @cached_property
    def gandoper_project(self) -> DataFrame:
        o = self.orders_x
        price, status = F.col("o_totalprice"), F.col("o_orderstatus")
        key = F.col("o_orderkey")
        cols = {
            "index": key,
            "Code": op_code(key, F.col("o_orderpriority")),
            "f_CodeIdent": F.concat(F.lit("K"), key.cast("string")),
            "DurPlanD": F.when(status == "P", _null()).otherwise(price / 1000.0),
            "Start": F.col("o_orderdate"),
            "Fin": F.col("o_orderdate"),
            "VolPlan": price,
            "project_type": F.lit(L.PROJECT),
            "object": F.col("n_name"),
            "Calen": F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("SR_10"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("SR_20")).otherwise(F.lit("STD")),
            "nz_year": _null("string"),
            "nz_month": _null("string"),
            "c_pln_SMRSsI": price,
            "c_pln_SMRSpI": F.when(status == "F", _null()).otherwise(price * 0.1),
        }
        plan_costs = {"Materl": price * 0.4, "OplGpd": price * 0.2,
                      "St_Mex": F.when(status == "O", price * 0.05)}
        for part in L.COST_PARTS:
            cols[f"c_pln_{part}"] = plan_costs.get(part, _null())
        cols.update({
            "c_pln_UslGpd": price * 0.03,
            "c_act_AmLiz": price * 0.01,
            "c_act_RepMiM": price * 0.02,
            "c_act_FuelMiM": F.when(status == "F", price * 0.03),
            "c_act_FnOpTr": _null(),
            "s_act_CC_SMRFull": F.when(status == "F", price),
            "s_pln_CC_SMRFull": price,
            "s_act_CC_SMRSsI": F.when(status == "F", price),
            "s_act_CC_SMRSpI": _null(),
            "s_pln_CC_SMRSsI": price,
            "s_pln_CC_SMRSpI": price * 0.1,
            "WorkLoadFact": F.when(status == "P", _null()).otherwise(price / 1000.0),
            "Name": F.concat(F.lit("Operation "), key.cast("string")),
            "Ispol": F.col("c_name"),
            "IspolUch": F.col("c_mktsegment"),
            "Real": F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Собственные силы"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("Собственными силами"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit("Субподряд"))
            .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Силами субподрядных организаций"))
            .otherwise(F.col("c_mktsegment")),
            "SNT_Knstr": F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(L.EARTHWORK))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit(L.PAVEMENT))
            .otherwise(F.col("o_orderpriority")),
            "SNT_KnstrE": status,
            "SNT_TypeKnstrE": F.col("o_orderpriority"),
            "SNT_Obj": F.col("n_name"),
            "Num_Con": F.concat(F.lit("CP-"), F.col("o_custkey").cast("string")),
        })
        return o.select(*[c.alias(n) for n, c in cols.items()])

    @cached_property
    def gandoper_snapshots(self) -> DataFrame:
        li = self.lineitem_x
        price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
        key = F.col("l_orderkey")
        return li.select(
            key.alias("index"),
            op_code(key, F.col("o_orderpriority")).alias("Code"),
            F.concat(F.lit("K"), key.cast("string")).alias("f_CodeIdent"),
            F.col("l_quantity").alias("DurPlanD"),
            F.col("o_orderdate").alias("Start"),
            F.col("l_shipdate").alias("Fin"),
            F.col("l_quantity").alias("VolPlan"),
            snapshot_type(F.col("l_linestatus")).alias("project_type"),
            F.col("n_name").alias("object"),
            F.year("l_shipdate").cast("string").alias("nz_year"),
            rus_month(F.col("l_shipdate")).alias("nz_month"),
            F.when(F.col("l_returnflag") == "R", price * disc).otherwise(F.lit(0.0)).alias("s_act_CC_SMRFull"),
            F.when(F.col("l_returnflag") == "N", price).otherwise(F.lit(0.0)).alias("s_pln_CC_SMRFull"),
            (price * disc).alias("s_act_CC_SMRSsI"),
            (price * tax).alias("s_act_CC_SMRSpI"),
            price.alias("s_pln_CC_SMRSsI"),
            _null().alias("s_pln_CC_SMRSpI"),
        )

    @cached_property
    def gandoper(self) -> DataFrame:
        """All operations: the project rows and the period snapshots."""
        return self.gandoper_project.unionByName(self.gandoper_snapshots, allowMissingColumns=True)

    @cached_property
    def plan_lines(self) -> DataFrame:
        """Operations with duplicate keys: one per line item, key (order, line number)."""
        li = self.t.lineitem
        price = F.col("l_extendedprice")
        cols = {
            "index": F.col("l_orderkey"),
            "Code": F.concat(F.lit("LN-"), F.col("l_linenumber").cast("string")),
            "DurPlanD": F.col("l_quantity"),
            "Start": F.col("l_shipdate"),
            "Fin": F.col("l_shipdate"),
            "VolPlan": F.col("l_quantity"),
            "project_type": F.lit(L.PROJECT),
            "object": F.concat(F.lit("SITE-"), F.col("l_returnflag")),
            "Calen": F.lit("STD"),
            "c_pln_SMRSsI": price,
            "c_pln_SMRSpI": F.when(F.col("l_tax") > 0, price * F.col("l_tax")),
            "c_pln_UslGpd": price * F.col("l_discount"),
        }
        for part in L.COST_PARTS:
            cols[f"c_pln_{part}"] = price * 0.4 if part == "Materl" else _null()
        return li.select(*[c.alias(n) for n, c in cols.items()])

    @cached_property
    def archive(self) -> DataFrame:
        li = self.lineitem_x
        price = F.col("l_extendedprice")
        flag = F.col("l_returnflag")
        cols = {
            "index": F.col("l_orderkey"),
            "OperCode": op_code(F.col("l_orderkey"), F.col("o_orderpriority")),
            "ResCode": F.when(flag == "N", _null("string"))
            .when(flag == "R", F.concat(F.lit("NT_"), F.col("l_suppkey").cast("string")))
            .otherwise(F.concat(F.lit("RS_"), F.col("l_suppkey").cast("string"))),
            "Start": F.col("o_orderdate"),
            "Fin": F.col("l_shipdate"),
            "Vol": F.col("l_quantity"),
            "project_type": F.lit(L.PROJECT),
            "object": F.col("n_name"),
            "c_aac_SMRSsI": price,
            "c_aac_SMRSpI": F.when(F.col("l_tax") > 0, price * F.col("l_tax")),
            "c_aac_UslGpd": price * F.col("l_discount"),
        }
        fact_costs = {"Materl": price * 0.4, "FnOpTr": F.col("l_quantity") * 10.0}
        for part in L.COST_PARTS:
            cols[f"c_aac_{part}"] = fact_costs.get(part, _null())
        cols["WorkLoadFact"] = F.col("l_quantity")
        return li.select(*[c.alias(n) for n, c in cols.items()])

    @cached_property
    def cost(self) -> DataFrame:
        li = self.lineitem_x
        flag = F.col("l_returnflag")
        return li.select(
            F.col("n_name").alias("object"),
            F.year("l_shipdate").cast("string").alias("nz_year"),
            rus_month(F.col("l_shipdate")).alias("nz_month"),
            snapshot_type(F.col("l_linestatus")).alias("project_type"),
            F.when(flag == "N", F.lit("SMRSsI")).when(flag == "R", F.lit("SMRSpI"))
            .otherwise(F.lit("SMRFull")).alias("Code"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("f_act_Total"),
            F.col("l_extendedprice").alias("f_pln_Total"),
        )

    @cached_property
    def calen_except(self) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in
                               ["Calen_Code", "Start", "Fin", "Start_true", "Fin_true"]])
        df = self.spark.createDataFrame(list(self.params.calendar_exceptions), schema)
        return df.select("Calen_Code", *[F.col(c).cast("timestamp_ntz").alias(c)
                                         for c in ["Start", "Fin", "Start_true", "Fin_true"]])

    # -- contract price list ----------------------------------------------------------------------
    @cached_property
    def vdc(self) -> DataFrame:
        c = self.t.customer
        n = self.t.nation.select("n_nationkey", "n_name")
        return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_name").alias(L.COL_WORK_NAME),
            F.concat(F.lit("CP-"), F.col("c_custkey").cast("string")).alias(L.COL_CIPHER),
            (F.col("c_acctbal") * 100.0).alias(L.COL_CONTRACT_SMR),
            F.col("n_name").alias("object"),
            (F.col("c_acctbal") / 100.0).alias(L.COL_VOLUME),
            F.col("c_mktsegment").alias(L.COL_UNITS),
            F.col("c_acctbal").alias(L.COL_UNIT_PRICE),
        )

    @cached_property
    def vdc_flawed(self) -> DataFrame:
        """The positions with every 50th customer's twice, and every 70th's cipher or site left out."""
        rows = self.vdc
        number = F.regexp_extract(L.COL_CIPHER, "[0-9]+", 0).cast("long")
        rows = rows.withColumn("_n", number).withColumn("_times", F.when(F.col("_n") % 50 == 0, 2).otherwise(1))
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        rows = rows.withColumn(L.COL_CIPHER, F.when(F.col("_n") % 70 != 0, F.col(L.COL_CIPHER)))
        rows = rows.withColumn("object", F.when(F.col("_n") % 140 != 0, F.col("object")))
        return rows.drop("_n", "_times", "_copy")

    # -- ERP ------------------------------------------------------------------------------------------
    @cached_property
    def works(self) -> DataFrame:
        key = F.col("o_orderkey").cast("string")
        return self.t.orders.select(
            F.concat(F.lit("W"), key).alias("work_id"),
            F.concat(F.lit("Z"), key).alias("zhufvr_id"),
            F.col("o_orderpriority").alias("type_work_name"),
            F.col("o_orderstatus").alias("enrp_type"),
            F.concat(F.lit("K "), key).alias("structure_unique_code"),
            F.concat(F.lit("OP- "), key).alias("structure_works_code"),
            (F.col("o_orderstatus") == "F").alias("structure_is_delete"),
        )

    @cached_property
    def zhufvr(self) -> DataFrame:
        c = self.t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
        o = self.t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"))
        return o.select(
            F.concat(F.lit("Z"), F.col("o_orderkey").cast("string")).alias("link"),
            F.col("c_nationkey").cast("string").alias("territory_value"),
            F.col("o_orderdate").alias("zhfvr_date"),
            F.when(F.col("o_orderstatus") == "O", F.lit("day")).otherwise(F.lit("night")).alias("work_shift_name"),
            (F.col("c_acctbal") < 0).alias("delete_flag"),
            (F.col("o_orderstatus") != "P").alias("is_done"),
        )

    @cached_property
    def objects(self) -> DataFrame:
        n = self.t.nation
        return n.select(
            F.col("n_nationkey").cast("string").alias("territory_value"),
            F.when(F.col("n_regionkey") == 0, _null("string")).otherwise(F.col("n_name")).alias("spider_name"),
        )

    @cached_property
    def technique_workers(self) -> DataFrame:
        p = self.params
        li = self.t.lineitem.where(F.col("l_returnflag") != "A")
        # the flags are single ASCII letters: their minimum is taken on the character code, which
        # keeps this a hash aggregate (a minimum over strings would force a sort-based one)
        g = li.groupBy("l_orderkey", "l_suppkey").agg(
            F.chr(F.min(F.ascii("l_linestatus"))).alias("_status"),
            F.max("l_tax").alias("_tax"),
            F.chr(F.min(F.ascii("l_returnflag"))).alias("_flag"),
            F.sum(hours_of(F.col("l_quantity") * (1 - F.col("l_tax")))).cast(L.HOURS_TYPE).alias("hours"),
        )
        supp = F.col("l_suppkey").cast("string")
        return g.select(
            F.concat(F.lit("W"), F.col("l_orderkey").cast("string")).alias("work_id"),
            F.concat(F.lit("S"), supp).alias("analytics_value"),
            F.concat(F.when(F.col("_status") == "O", F.lit("(НТ) ")).otherwise(F.lit("")),
                     F.lit("Supplier "), supp).alias("analytics_name"),
            F.when(F.col("_tax") >= 0.05, F.lit(p.own_contractor_name))
            .when(F.col("_tax") > 0, F.concat(F.lit(p.hired_contractor_prefix), supp))
            .alias("contragent_name"),
            F.when(F.col("_tax") >= 0.05, F.lit(p.own_contractor_value))
            .otherwise(F.concat(F.lit("C"), supp)).alias("contragent_value"),
            F.concat(F.lit("RES-"), F.col("_flag")).alias("res_name"),
            F.concat(F.lit("RC-"), F.col("_flag")).alias("res_code"),
            F.col("hours"),
        )

    def _norm_code(self) -> Column:
        return F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R"),
                      F.lit(L.MAIN_WORKER_CODE)).otherwise(F.concat(F.lit("RC-"), F.col("l_returnflag")))

    @cached_property
    def norm_workload(self) -> DataFrame:
        li = self.t.lineitem.where(F.col("l_returnflag") != "N")
        return li.select(
            F.concat(F.lit("W"), F.col("l_orderkey").cast("string")).alias("work_id"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("analytics_value"),
            F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("res_spider_name"),
            self._norm_code().alias("res_spider_code"),
            F.when(F.col("l_discount") == 0, hours_of(F.lit(0))).otherwise(hours_of(F.col("l_quantity") * (1.26 - F.col("l_tax"))))
            .alias("fact_workload"),
            hours_of(F.col("l_quantity") * (1 - F.col("l_discount"))).alias("norm_workload"),
            (F.col("l_tax") > 0.04).alias("nt_res"),
        )

    @cached_property
    def key_res(self) -> DataFrame:
        # an expression, not a list handed to the session: its size is known, so joins need not shuffle their rows for it
        pairs = F.array(*[F.struct(F.lit(t).alias("f_opertype"), F.lit(c).alias("rescode")) for t, c in self.params.key_resources])
        return self.spark.range(1).select(F.inline(pairs))

    @cached_property
    def kol_ekip(self) -> DataFrame:
        li = self.t.lineitem.where(F.col("l_returnflag") != "N")
        return li.groupBy(self._norm_code().alias("Code")).agg(
            (F.max("l_quantity") / 10.0).alias("Kol_Ekip"))

    @staticmethod
    def _quarter(ts: str) -> Column:
        return F.date_trunc("quarter", F.col(ts)).cast("timestamp_ntz")

    @cached_property
    def fot(self) -> DataFrame:
        li = self.t.lineitem
        g = li.groupBy(F.concat(F.lit("RES-"), F.col("l_returnflag")).alias("res"),
                       self._quarter("l_shipdate").alias("start")).agg(
            (F.max(F.col("l_extendedprice") / F.when(F.col("l_quantity") != 0, F.col("l_quantity")))
             / 100.0).alias("fot"))
        # valid for the first two months of the quarter: lookups in a quarter's last month find no rate
        return g.select("res", "start", (F.col("start") + F.make_ym_interval(F.lit(0), F.lit(2))).alias("finish"),
                        "fot")

    @cached_property
    def mim(self) -> DataFrame:
        li = self.lineitem_x
        g = li.groupBy(F.concat(F.lit("RES-"), F.col("l_returnflag")).alias("res"),
                       F.col("n_name").alias("object"),
                       self._quarter("o_orderdate").alias("start")).agg(
            F.max(F.col("l_extendedprice") * F.col("l_discount")).alias("leasing"),
            F.max(F.col("l_extendedprice") * F.col("l_tax")).alias("repair"),
            F.max("l_quantity").alias("fuel"))
        # valid four months from the quarter start: each overlaps the next quarter's rate by a month
        # (the overlap check reports them; lookups in that month match two rates, as in the reference)
        return g.select("res", "object", "start",
                        (F.col("start") + F.make_ym_interval(F.lit(0), F.lit(4))).alias("finish"),
                        "leasing", "repair", "fuel")
