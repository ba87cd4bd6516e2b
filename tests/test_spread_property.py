"""Month spread vs. a brute-force model of the recursive definition, on random interval sets.

The model follows the definition step by step (add one month while the next month start is not after
the end's month; first part by smallest start of the key; bounds; zero-length filter; weights), in
plain Python over a few hundred rows, so the closed form and both execution paths are checked on
cases no fixture lists: duplicate keys, equal starts, null bounds, ends before starts, midnight ends.
"""

from __future__ import annotations

import calendar
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from periodix.operators.spread import key_steps, lay_out_steps, month_parts, month_weights


def add_month(d: datetime) -> datetime:
    y, m = (d.year + 1, 1) if d.month == 12 else (d.year, d.month + 1)
    return d.replace(year=y, month=m, day=min(d.day, calendar.monthrange(y, m)[1]))


def trunc(d):
    return None if d is None else d.replace(day=1, hour=0, minute=0, second=0, microsecond=0)


def model(rows):
    """{(key, year, month): total weight} by the recursive definition (None weights kept as None)."""
    parts = []   # (key, start_date, end_date) as the recursion produces them
    for key, s, e in rows:
        cur = s
        parts.append((key, cur, e))
        while cur is not None and e is not None and trunc(add_month(cur)) <= trunc(e):
            cur = add_month(cur)
            parts.append((key, cur, e))
    by_key = {}
    for key, s, e in parts:
        by_key.setdefault(key, []).append((s, e))
    out = {}
    for key, ps in by_key.items():
        starts = [s for s, _ in ps if s is not None]
        min_s = min(starts) if starts else None
        bounded = []
        for s, e in ps:
            first = s is not None and s == min_s
            if first:
                ns, ne = s, min(x for x in (e, add_month(trunc(s))) if x is not None)
            else:
                ns = trunc(s)
                if s is None:
                    ne = None
                elif e is not None and trunc(s) == trunc(e):
                    ne = e
                else:
                    ne = add_month(trunc(s))
            dur = None if ns is None or ne is None else (ne - ns) / timedelta(microseconds=1)
            bounded.append((ns, dur))
        n = len(bounded)
        kept = [(ns, d) for ns, d in bounded if not (d is not None and d == 0 and n > 1) and not (d is None and n > 1)]
        total = sum(d for _, d in kept if d is not None)
        for ns, d in kept:
            if d is None:
                w = None
            elif d == 0:
                w = 1.0
            else:
                w = None if total == 0 else d / total
            k = (key, None if ns is None else ns.year, None if ns is None else ns.month)
            if k in out and out[k] is not None and w is not None:
                out[k] += w
            elif k not in out:
                out[k] = w
        # (a None weight next to a number in one month cannot occur: null parts have null months)
    return out


def random_rows(seed: int, n: int, dup_keys: bool):
    rng = random.Random(seed)
    base = datetime(2023, 1, 1)
    rows = []
    for i in range(n):
        key = rng.randrange(n // 3) if dup_keys else i
        choice = rng.random()
        s = base + timedelta(days=rng.randrange(700), hours=rng.choice([0, 0, 6, 23]))
        if choice < 0.05:
            s = None
        if choice < 0.1:
            e = None
        elif choice < 0.2:
            e = trunc(s or base) + timedelta(days=0)       # midnight on the 1st
            e = add_month(e)
        elif choice < 0.3:
            e = s                                           # zero length
        else:
            e = (s or base) + timedelta(days=rng.randrange(-40, 400), minutes=rng.choice([0, 30]))
        rows.append((key, s, e))
    return rows


@pytest.mark.parametrize("seed,dup", [(1, True), (2, True), (3, False), (4, False)])
def test_spread_matches_model(spark, seed, dup):
    rows = random_rows(seed, 300, dup)
    df = spark.createDataFrame(rows, "k long, s timestamp_ntz, e timestamp_ntz")
    expected = model(rows)
    got = {(r.k, r.start_year, r.start_month): r.weight
           for r in month_weights(df, ["k"], "s", "e", unique_key=not dup).collect()}
    assert set(got) == set(expected)
    for k, w in expected.items():
        assert (got[k] is None) == (w is None), k
        if w is not None:
            assert got[k] == pytest.approx(w, rel=1e-12, abs=1e-12), k
    if not dup:
        general = {(r.k, r.start_year, r.start_month): r.weight for r in month_weights(df, ["k"], "s", "e").collect()}
        assert general == got


def test_weights_sum_to_one_per_key(spark):
    rows = [r for r in random_rows(7, 400, True) if r[1] is not None]
    df = spark.createDataFrame(rows, "k long, s timestamp_ntz, e timestamp_ntz")
    sums = month_parts(df, ["k"], "s", "e").groupBy("k").agg(F.sum("weight").alias("w"))
    bad = [r for r in sums.collect() if r.w is not None and abs(r.w - 1.0) > 1e-9]
    # a key can exceed 1 only through zero-length single parts; none remain when a key has more parts
    assert not bad


def test_hot_key_holding_a_third_of_rows(spark):
    """One key carrying a third of the rows (derived from the driver's line items): the key-aggregate
    path must give the model's weights, with no per-key window or per-key buffering involved."""
    from pyspark.sql import functions as G

    from tests.conftest import SF_SMALL

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    rows_df = li.select(
        G.when(G.col("l_returnflag") == "A", G.lit(-1)).otherwise(G.col("l_orderkey")).alias("k"),
        (G.col("l_shipdate") - G.make_dt_interval(G.col("l_quantity").cast("int"))).alias("s"),
        G.col("l_shipdate").alias("e"))
    rows = [(r.k, r.s, r.e) for r in rows_df.collect()]
    hot = sum(1 for r in rows if r[0] == -1)
    assert hot > len(rows) / 4
    expected = model(rows)
    weights = month_weights(rows_df, ["k"], "s", "e")
    got = {(r.k, r.start_year, r.start_month): r.weight for r in weights.collect()}
    assert set(got) == set(expected)
    assert all(got[k] == pytest.approx(w, rel=1e-12, abs=1e-12) for k, w in expected.items())
    hot_total = sum(w for (k, _, _), w in got.items() if k == -1)
    assert hot_total == pytest.approx(1.0)


def test_endless_intervals_of_one_key(spark):
    """Many intervals to the year 9999: their months are laid out once for the key, not once for each interval."""
    rows = [(1, datetime(2024, 1, 1 + i % 28), datetime(9999, 12, 31)) for i in range(60)] + [(1, datetime(2024, 2, 3), datetime(2024, 5, 6)), (2, None, datetime(2024, 1, 1))]
    weights = month_weights(spark.createDataFrame(rows, "k long, s timestamp_ntz, e timestamp_ntz"), ["k"], "s", "e")
    got = {(r.k, r.start_year, r.start_month): r.weight for r in weights.where("k = 2 or start_year in (2024, 5000, 9999)").collect()}
    expected = model([(1, datetime(2024, 1, 1 + i % 28), datetime(2027, 12, 31)) for i in range(60)] + rows[60:])
    assert got[2, None, None] is None and len(got) == 37
    # a middle month against another: covered by the same number of intervals, so in proportion to their days
    assert got[1, 5000, 1] / got[1, 9999, 11] == pytest.approx(31 / 30)
    assert got[1, 2024, 3] / got[1, 2024, 7] == pytest.approx(expected[1, 2024, 3] / expected[1, 2024, 7])
    assert weights.where("k = 1").count() == (9999 - 2024 + 1) * 12


@pytest.mark.parametrize("seed", [11, 12])
def test_steps_of_a_key_lay_out_its_months(spark, seed):
    """One row for each key holds its months: laid out behind a join they are the model's, for each row that has joined."""
    rows = random_rows(seed, 300, True) + [(1000, datetime(2024, 1, 5), datetime(9999, 12, 31)), (1001, None, datetime(2024, 1, 1))]
    expected = {k: w for k, w in model([r for r in rows if r[0] != 1000]).items()}
    steps = key_steps(spark.createDataFrame([*rows, (None, rows[0][1], rows[0][2])], "k long, s timestamp_ntz, e timestamp_ntz"), ["k"], "s", "e")
    assert steps.count() == len({r[0] for r in rows})
    twice = steps.crossJoin(spark.createDataFrame([("x",), ("y",)], "v string"))
    months = lay_out_steps(twice, ["k", "v"])
    assert months.where("k = 1000").count() == 2 * (9999 - 2024 + 1) * 12
    for v in "xy":
        got = [((r.k, r.start_year, r.start_month), r.weight) for r in months.where(F.col("v") == v).where("k <> 1000").collect()]
        assert len(got) == len(expected) and {k for k, _ in got} == set(expected)
        for k, w in got:
            assert (w is None) == (expected[k] is None) and (w is None or w == pytest.approx(expected[k], rel=1e-12, abs=1e-12)), k
