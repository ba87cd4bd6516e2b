"""Lookup of values valid on a date: equi keys plus ``start <= date < finish``.

A plain equi-join with the range as a residual condition pairs every row with *every* interval of its key before it
filters. Here a row meets only intervals that overlap the dates near its own, however long an interval or a key's history
is: rows are sorted by key and date and cut into blocks, an interval is copied once to each block whose dates of its key
it overlaps, and rows are joined with their block's copies. A "valid forever" sentinel such as 9999-12-31 costs one copy
for a block of rows, and a hot key's rows lie in many blocks. Overlapping intervals still all match, as in the reference;
:func:`overlapping_intervals` reports them.

Where the whole dictionary is small and no key has a long history, both of which are counted, it is broadcast instead and
the rows are not moved at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from periodix.operators.skew import join_per_key
from periodix.sources.work import fixed

#: A dictionary of at most so many intervals, and of at most so many for a key, is broadcast.
BROADCAST_INTERVALS = 50_000
BROADCAST_HISTORY = 64
#: Rows of a block, as a power of two.
BLOCK_BITS = 10


def _valid(date: Column, start: Column, finish: Column) -> Column:
    return (date >= start) & (date < finish)


def validity_join(
    left: DataFrame,
    rates: DataFrame,
    on: Sequence[tuple[str, str]],
    date: str,
    start: str = "start",
    finish: str = "finish",
    how: str = "left",
    broadcast_intervals: int = BROADCAST_INTERVALS,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Join ``rates`` rows whose ``[start, finish)`` contains ``left[date]`` and whose keys match.

    ``on`` pairs left and right key column names. Output: all left columns plus the rates columns
    (keys and bounds included, as given). Null keys and intervals with a null bound or of no length never match; a left
    row without a match stays when ``how`` is ``"left"`` and goes when it is ``"inner"``.
    """
    keys = [r for _, r in on]
    bounded = rates.where(F.col(start) < F.col(finish)).dropna("any", subset=keys)
    bounded = fixed(bounded, "intervals")  # counted, then joined
    size = bounded.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("history")).first()
    if (size["all"] or 0) <= broadcast_intervals and (size["history"] or 0) <= BROADCAST_HISTORY:
        cond = _valid(left[date], bounded[start], bounded[finish])
        for lk, rk in on:
            cond = cond & (left[lk] == bounded[rk])
        return left.join(F.broadcast(bounded), cond, how)
    return _by_blocks(left, bounded, on, date, start, finish, how, block_bits)


def _by_blocks(left: DataFrame, rates: DataFrame, on: Sequence[tuple[str, str]], date: str, start: str, finish: str,
               how: str, block_bits: int) -> DataFrame:
    """The lookup by blocks of rows sorted by key and date."""
    order = [*[lk for lk, _ in on], date]
    # rows of one key and date, and rows that can match nothing, are dealt to several ranges as well
    salted = left.withColumn("_vj_salt", F.rand(7))
    rows = salted.repartitionByRange(*order, "_vj_salt").sortWithinPartitions(*order).drop("_vj_salt")
    rows = rows.withColumn("_vj_block", F.shiftright(F.monotonically_increasing_id(), block_bits))
    rows = fixed(rows, "by-date")
    named = [f"_vj_k{i}" for i in range(len(on))]
    spans = rows.dropna("any", subset=order).groupBy("_vj_block", *[F.col(lk).alias(n) for (lk, _), n in zip(on, named)]).agg(
        F.min(date).alias("_vj_low"), F.max(date).alias("_vj_high"))
    near = (F.col(start) <= F.col("_vj_high")) & (F.col(finish) > F.col("_vj_low"))
    for (_, rk), n in zip(on, named):
        near = near & (F.col(n) == rates[rk])
    copies = spans.join(rates, near).select(F.col("_vj_block").alias("_vj_at"), *[rates[c] for c in rates.columns])
    cond = (rows["_vj_block"] == copies["_vj_at"]) & _valid(rows[date], copies[start], copies[finish])
    for lk, rk in on:
        cond = cond & (rows[lk] == copies[rk])
    return rows.join(copies, cond, how).drop("_vj_block", "_vj_at")


def overlapping_intervals(rates: DataFrame, keys: Sequence[str], start: str = "start",
                          finish: str = "finish", block_bits: int = BLOCK_BITS) -> DataFrame:
    """Intervals that overlap an earlier interval of the same key (they would double a lookup).

    Ordered by start, then finish, within the key; a row overlaps when it starts before the largest finish seen so far.
    Intervals are sorted by range and cut into blocks; each block's largest finish of a key is found first, and what a
    block inherits from those before it is their running maximum, over one row for each block. A key with very many
    intervals is thus never sorted in one task. A null key part is one group; a null start never overlaps.
    """
    order = [*keys, start, finish]
    rows = rates.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = fixed(rows.withColumn("_block", F.shiftright("_at", block_bits)), "by-start")
    blocks = rows.groupBy(*keys, "_block").agg(F.max(finish).alias("_reach"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = blocks.select(*keys, "_block", F.max("_reach").over(earlier).alias("_inherited"))
    here = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("_seen", F.max(finish).over(here))
    seen = join_per_key(seen, inherited, [*keys, "_block"])
    reach = F.greatest(F.col("_seen"), F.col("_inherited"))  # nulls are left out
    return seen.where(F.col(start) < reach).select(*rates.columns)
