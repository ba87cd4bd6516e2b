"""PostgreSQL-parity helpers (traps T1-T7, T11 of the survey)."""

import math
import random
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle.sums import exact_sum as oracle_sum
from periodix.functions import (
    add_months,
    concat_skip_nulls,
    is_false,
    is_true,
    month_start,
    nullif,
    replace_first,
    round_half_even,
    strip_spaces,
    subtract_days,
    zero_pad_month,
)
from periodix.functions.sums import exact_sum


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_concat_skips_nulls(spark):  # T1
    r = one(spark, a=concat_skip_nulls(F.lit("X"), F.lit("    "), F.lit(None).cast("string")),
            b=concat_skip_nulls(F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert r.a == "X    " and r.b == ""


def test_round_half_even(spark):  # T2
    r = one(spark, a=round_half_even(F.lit(2.5)), b=round_half_even(F.lit(3.5)), c=round_half_even(F.lit(-2.5)))
    assert (r.a, r.b, r.c) == (2.0, 4.0, -2.0)


def test_replace_first_only(spark):  # T3
    r = one(spark, a=replace_first(F.lit("Kzn_A_Kzn_B"), "Kzn_"), b=replace_first(F.lit("none"), "Kzn_"),
            c=replace_first(F.lit("x.y.z"), "."))
    assert (r.a, r.b, r.c) == ("A_Kzn_B", "none", "xy.z")


def test_month_start_stays_ntz(spark):  # T5
    df = spark.range(1).select(month_start(F.lit(datetime(2024, 1, 31, 10)).cast("timestamp_ntz")).alias("m"))
    assert df.schema["m"].dataType.simpleString() == "timestamp_ntz"
    assert df.first().m == datetime(2024, 1, 1)


def test_add_months_clamps_day(spark):
    ts = F.lit(datetime(2024, 1, 31, 10)).cast("timestamp_ntz")
    r = one(spark, a=add_months(ts, 1), b=add_months(add_months(ts, 1), 1))
    assert r.a == datetime(2024, 2, 29, 10) and r.b == datetime(2024, 3, 29, 10)


def test_nullif_guards_division(spark):  # T7 (ANSI mode would raise without it)
    r = one(spark, a=F.lit(5.0) / nullif(F.lit(0.0), 0))
    assert r.a is None


def test_like_underscore_is_wildcard(spark):  # T11
    df = spark.createDataFrame([("NT_1",), ("NTX1",), ("NT_",), ("NT",)], "c string")
    got = sorted(r.c for r in df.where(F.col("c").like("NT_%")).collect())
    assert got == ["NTX1", "NT_", "NT_1"]


def test_three_valued_booleans(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    r = df.select(F.sum(is_true("b").cast("int")).alias("t"), F.sum(is_false("b").cast("int")).alias("f")).first()
    assert (r.t, r.f) == (1, 1)


def test_zero_pad_month(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "m int")
    assert [r.s for r in df.select(zero_pad_month("m").alias("s")).collect()] == ["09", "10", "0"]


def test_strip_spaces_and_fractional_days(spark):
    r = one(spark, a=strip_spaces(F.lit("4-NOT SPECIFIED 1")),
            b=subtract_days(F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz"), F.lit(1.5)))
    assert r.a == "4-NOTSPECIFIED1" and r.b == datetime(2024, 2, 28, 12)


def test_exact_sums_do_not_depend_on_layout(spark):
    rng = random.Random(8)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 12) for _ in range(4000)] + [1e15, -1e15, 0.1, -0.1, 3e-9, -7e-12, None]
    sums = set()
    for parts, seed in ((1, 1), (3, 2), (8, 3)):
        rng.shuffle(values)
        rows = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "x double, g int").repartition(parts)
        sums.add(rows.agg(exact_sum(F.col("x")).alias("s")).first().s)
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(math.fsum(v for v in values if v is not None), rel=1e-15)


@pytest.mark.parametrize("values, want", [
    ([0.1] * 10, 1.0), ([-0.1] * 3, -0.30000000000000004), ([1e17, 1.0, -1e17], 1.0), ([-1e-3, 1e-3], 0.0), ([2.0**60, 2.0**-40, -(2.0**60)], 2.0**-40),
    ([None], None), ([], None), ([1.0, float("nan")], math.nan), ([float("inf"), 1.0], math.inf), ([float("inf"), -float("inf")], math.nan), ([-5.25, None, 2.0], -3.25)])
def test_exact_sum_values(spark, values, want):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum(F.col("x")).alias("s")).first().s
    if want is None or math.isnan(want):
        assert got is None if want is None else math.isnan(got)
    else:
        assert got == pytest.approx(want, rel=1e-15, abs=2.3e-16 * len(values))
    sql = ", ".join(f"({'NULL' if v is None else repr(v)}::DOUBLE)" for v in values if v is None or math.isfinite(v))
    if want is not None and math.isfinite(want):
        assert duckdb.sql(f"SELECT {oracle_sum('x')} FROM (VALUES {sql}) AS t(x)").fetchall()[0][0] == got


def test_exact_sum_cuts_as_remainders_do(spark):
    """Whole parts by a cast are those that the remainder of doubles leaves, to the last bit."""
    import math
    import random

    from periodix.functions.sums import CUTS, _parts

    r = random.Random(5)
    values = [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-20, 26) for _ in range(400)] + [0.0, -0.0, 5e-324, 6e26, 2.0**52 + 1, 0.1]

    def parts(x):
        above = [x, *[math.fmod(x, c) for c in CUTS]]
        return tuple(int((a - b) / c) for a, b, c in zip(above, above[1:], CUTS))

    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = df.select("x", *[p.alias(f"p{i}") for i, p in enumerate(_parts(F.col("x")))])
    assert "%" not in out._jdf.queryExecution().executedPlan().toString()  # remainders of doubles are slow
    for row in out.collect():
        assert tuple(row)[1:] == parts(row.x)
