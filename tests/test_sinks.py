"""Tables that survive a failed refresh, and bucketed tables that later joins do not shuffle."""

import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from periodix.sources import sinks


def _folder():
    return tempfile.mkdtemp(prefix="periodix-sink-")  # a new scratch folder per run


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_failed_refresh_leaves_the_old_table(spark):
    base = _folder()
    old = spark.range(20).select("id", (F.col("id") % 3).alias("year"))
    sinks.write_table(old, base, "t", partition_by=["year"])
    failing = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") < 3900, F.lit(1)).otherwise(F.raise_error(F.lit("lost"))).alias("year"))
    for write in (lambda: sinks.write_table(failing, base, "t"), lambda: sinks.write_bucketed(failing, base, "t", ["id"], 2)):
        with pytest.raises(PySparkException):
            write()
        assert _rows(sinks.read_table(spark, base, "t").select("id", "year")) == _rows(old)
    new = spark.range(5).select("id", F.lit(7).alias("year"))
    assert _rows(sinks.write_table(new, base, "t")) == _rows(new)
    assert _rows(spark.read.parquet(f"{base}/t")) == _rows(new) and not os.path.exists(f"{base}/_aside/t")


def test_a_table_set_aside_comes_back(spark):
    """The job ends between the two renames."""
    base = _folder()
    sinks.write_table(spark.range(6), base, "t")
    sinks._move(spark, f"{base}/t", f"{base}/_aside/t")
    assert sinks.read_table(spark, base, "t").count() == 6
    sinks._move(spark, f"{base}/t", f"{base}/_aside/t")
    assert _rows(sinks.write_table(spark.range(2), base, "t")) == [(0,), (1,)]


def test_bucketed_tables_are_not_shuffled(spark):
    base = _folder()
    rows = spark.range(1000).select((F.col("id") % 90).alias("code"), F.concat(F.lit("S"), F.col("id") % 4).alias("object"), F.col("id").alias("x"))
    for _ in range(2):  # a refresh as well
        table = sinks.write_bucketed(rows, base, "t", ["code", "object"], buckets=8)
    other = spark.range(90).select(F.col("id").alias("k"), F.concat(F.lit("S"), F.col("id") % 4).alias("o"))
    joined = table.hint("merge").join(other, (F.col("code") == F.col("k")) & (F.col("object") == F.col("o")))
    sums = table.groupBy("object", "code").agg(F.sum("x").alias("x"))
    assert _rows(table) == _rows(rows) == _rows(spark.read.parquet(f"{base}/t"))
    assert _rows(sums) == _rows(rows.groupBy("object", "code").agg(F.sum("x").alias("x")))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(sums).count("Exchange") == 0 and plan(joined).count("Exchange hashpartitioning") == 1
    assert joined.count() == rows.join(other, (F.col("code") == F.col("k")) & (F.col("object") == F.col("o"))).count()
