"""Month spread: split each interval into calendar-month parts and weight them by duration.

Semantics (the reference builds the parts with a recursive query; this is its closed form):

* A row with start ``s`` and end ``e`` yields ``n = max(0, months(trunc(e)) - months(trunc(s))) + 1``
  parts (one part when either bound is null); part ``k`` lies in month ``trunc(s) + k``.
* The *first* part of a key is the ``k = 0`` part of a row whose start equals the smallest start of the
  key. It runs ``[s, least(e, next month))`` (``least`` skips a null end). Any other part runs from its
  month start to ``e`` when ``e`` is in the same month, otherwise to the next month start.
* Zero-length parts are dropped when the key has more than one part; a null-length part likewise
  (three-valued ``not (d = 0 and n > 1)``).
* ``weight = duration / sum(duration over the key)``, or 1 for a zero-length part.

Execution plan:

* ``unique_key=True`` (the caller guarantees one row per key): every quantity is row-local, so the whole
  spread is a narrow ``explode`` of a scan -- no shuffle at all.
* Otherwise the per-key quantities (smallest start, number of parts, total duration) come from a
  two-level partial aggregate and are joined back by key. Unlike a window partitioned by key, a hot key
  never has to be buffered inside one task: the aggregate combines map-side, and adaptive execution can
  split its rows in the join back (:func:`join_per_key`).
  The total duration needs no pass over the parts: a row contributes ``e - s`` when it holds the first
  part and ``e - trunc(s)`` (or one whole month) otherwise, so the totals are computed from the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from periodix.functions import add_months, micros_between, month_index, month_start
from periodix.operators.skew import join_on_keys, join_per_key

#: The microseconds of a day, exact as a double too.
DAY_US = 86_400_000_000

PART_COLUMNS = ["part_start", "part_end", "start_year", "start_month", "duration", "weight",
                "duration_us", "key_total_us", "key_parts"]


def _row_terms(start: Column, end: Column) -> dict[str, Column]:
    ms = month_start(start)
    me = month_start(end)
    m1 = add_months(ms, 1)
    n_parts = (
        F.when(start.isNull() | end.isNull(), F.lit(1))
        .otherwise(F.greatest(month_index(me) - month_index(ms), F.lit(0)) + 1)
    )
    # total duration of the row's parts when its k=0 part is / is not the key's first part
    dur_first = micros_between(start, F.coalesce(end, m1))
    dur_other = F.when(end.isNotNull() & (me >= ms), micros_between(ms, end)).otherwise(
        micros_between(ms, m1))
    return {"_ms": ms, "_me": me, "_m1": m1, "_n": n_parts, "_tf": dur_first, "_to": dur_other}


def _wide(us: Column) -> Column:
    """Microseconds that may be added up: a few thousand years of many rows are more than 64 bits hold."""
    return us.cast("decimal(19,0)")


def _key_stats(rows: DataFrame, keys: list[str], copies: Column) -> DataFrame:
    """Per key: smallest start, number of parts, total duration, by partial aggregation; a row stands for ``copies``."""
    per_start = rows.groupBy(*keys, "_s").agg(
        F.sum(F.col("_n") * copies).alias("_n"),
        F.sum(_wide(F.col("_to")) * copies).alias("_to"),
        F.sum(_wide(F.col("_tf") - F.col("_to")) * copies).alias("_delta"),
    )
    return per_start.groupBy(*keys).agg(
        F.min("_s").alias("_min_start"),
        F.sum("_n").alias("_n_parts"),
        F.sum("_to").alias("_sum_other"),
        # the first-part correction of the smallest non-null start (unique after the first level);
        # min_by skips null orderings and keeps a fixed-width buffer, so this stays a hash aggregate
        F.min_by("_delta", "_s").alias("_first_delta"),
    ).select(
        *keys, "_min_start", "_n_parts",
        (F.col("_sum_other") + F.col("_first_delta")).cast("decimal(38,0)").alias("_total"),
    )


def month_parts(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    carry: Sequence[str] = (),
    unique_key: bool = False,
    keep_all: bool = False,
    copies: str | None = None,
) -> DataFrame:
    """One row per kept month part: ``keys``, ``carry`` columns and :data:`PART_COLUMNS`.

    ``copies`` names a carried column that says how many equal rows a row stands for (one if not given).

    ``keep_all`` also returns the zero-length parts that the weighting drops (their weight is then
    not meaningful); the calendar adjustment works on that full set of parts.

    Rows with a null key never match their key in the reference (its join back uses ``=``), so they
    are dropped here, before any work.
    """
    keys = list(keys)
    carry = [c for c in carry if c not in keys]
    not_null = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        not_null = not_null & F.col(k).isNotNull()
    s, e = F.col(start), F.col(end)
    rows = df.where(not_null).select(*keys, *carry, s.alias("_s"), e.alias("_e"),
                                     *[c.alias(n) for n, c in _row_terms(s, e).items()])
    if unique_key:
        per_key = [F.col("_s").alias("_min_start"), F.col("_n").cast("long").alias("_n_parts"),
                   F.col("_tf").alias("_total")]
        rows = rows.select("*", *per_key)
    else:
        rows = join_per_key(rows, _key_stats(rows, keys, F.col(copies) if copies else F.lit(1)), keys)

    # one projection for the parts: explode the month offsets, then bounds and exact durations
    k = F.col("_k")
    part_month = add_months(F.col("_ms"), k)
    first = (k == 0) & (F.col("_s") == F.col("_min_start"))
    part_start = F.when(first, F.col("_s")).otherwise(part_month)
    part_end = (
        F.when(first, F.least(F.col("_e"), F.col("_m1")))
        .when(part_month == F.col("_me"), F.col("_e"))
        .otherwise(add_months(part_month, 1))
    )
    parts = rows.select(*keys, *carry, "_s", "_e", "_ms", "_me", "_m1", "_min_start", "_n_parts", "_total",
                        F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))
    parts = parts.select(*keys, *carry, "_n_parts", "_total", part_start.alias("part_start"),
                         part_end.alias("part_end"))
    # durations and totals are whole microseconds, so every weight is one exact division
    us = micros_between("part_start", "part_end")
    if not keep_all:
        parts = parts.where(~((us == 0) & (F.col("_n_parts") > 1)))
    total = F.when(F.col("_total") == 0, F.lit(None)).otherwise(F.col("_total"))
    weight = F.when(us == 0, F.lit(1.0)).otherwise(us.cast("double") / total.cast("double"))
    return parts.select(
        *keys, *carry, "part_start", "part_end",
        F.year("part_start").alias("start_year"),
        F.month("part_start").alias("start_month"),
        (us / 1e6).alias("duration"),
        weight.alias("weight"),
        us.alias("duration_us"),
        F.col("_total").alias("key_total_us"),
        F.col("_n_parts").alias("key_parts"),
    )


def _month_number(x: Column) -> Column:
    """Months since year 0, so that a difference of one is the next month."""
    return month_index(x) - 1


def _month_days(number: Column) -> Column:
    """The length of a month in days."""
    first = F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1))
    return F.day(F.last_day(first)).cast("long")


def _covered_us(number: Column) -> Column:
    """What ``_cover`` intervals that cover a month put into it."""
    return F.col("_cover") * _wide(_month_days(number) * DAY_US)


def _edges(intervals: DataFrame, keys: list[str], start: str, end: str, count: Column, unique_key: bool) -> DataFrame:
    """What the distinct intervals of a key put into single months, summed by (key, month).

    ``_num`` and ``_zeros`` are of the first and the last part of each interval; ``_delta`` says how many more intervals
    cover this month and those after it from end to end than the month before. Null months hold parts without a start.
    """
    s, e = F.col(start), F.col(end)
    rows = intervals.groupBy(*keys, start, end).agg(count.alias("_copies")).select(*keys, s.alias("_s"), e.alias("_e"), "_copies")
    terms = [c.alias(n) for n, c in _row_terms(F.col("_s"), F.col("_e")).items()]
    if unique_key:
        rows = rows.select("*", *terms)
        rows = rows.select("*", F.col("_s").alias("_min_start"), F.col("_n").alias("_n_parts"), F.col("_tf").cast("double").alias("_total"))
    else:
        stats = _key_stats(rows.select("*", *terms), keys, F.col("_copies")).withColumn("_total", F.col("_total").cast("double"))
        # an interval's own terms are worked out again behind the join rather than shuffled
        rows = join_on_keys(rows, stats, keys).select("*", *terms)
    first = F.col("_s") == F.col("_min_start")
    several = F.col("_n_parts") > 1
    # the first part runs to the end of its month unless the end comes before; the last one from the month's start
    same = F.col("_ms") == F.col("_me")
    head = (F.when(first, micros_between("_s", F.least(F.col("_e"), F.col("_m1"))))
            .when(same, micros_between("_ms", "_e")).otherwise(micros_between("_ms", "_m1")))
    tail = micros_between("_me", "_e")
    copies, month, none = F.col("_copies"), _month_number(F.col("_ms")), F.lit(None).cast("long")

    def event(at: Column, us: Column, delta: Column) -> Column:
        return F.struct(at.cast("int").alias("_month"), F.when(us != 0, _wide(us) * copies).cast("decimal(38,0)").alias("_num"),
                        F.when((us == 0) & ~several, copies).alias("_zeros"), delta.alias("_delta"))

    later = F.when(F.col("_n") > 1, F.array(event(_month_number(F.col("_me")), tail, F.when(F.col("_n") > 2, -copies))))
    cover = F.when(F.col("_n") > 2, F.array(event(month + 1, none, copies)))
    empty = F.array().cast("array<struct<_month:int,_num:decimal(38,0),_zeros:bigint,_delta:bigint>>")
    events = rows.select(*keys, "_total", several.alias("_several"), F.explode(
        F.concat(F.array(event(month, head, none)), F.coalesce(later, empty), F.coalesce(cover, empty))).alias("_event"))
    events = events.select(*keys, "_total", "_several", "_event.*")
    # of several parts those without a length, or without a start, are dropped
    events = events.where(~F.col("_several") | F.col("_num").isNotNull() | F.col("_delta").isNotNull())
    return events.groupBy(*keys, "_month").agg(
        F.sum("_num").alias("_num"), F.sum("_zeros").alias("_zeros"), F.sum("_delta").alias("_delta"), F.max("_total").alias("_total"))


def _steps(df: DataFrame, keys: list[str], start: str, end: str, unique_key: bool, copies: str | None) -> DataFrame:
    """One row per key and month with an event, and the number of months after it (``_steps``) that stay as it leaves them."""
    rows = df
    for k in keys:  # each by itself, as the join on the keys asks for it, so that both its sides read the same table
        rows = rows.where(F.col(k).isNotNull())
    sums = _edges(rows, keys, start, end, F.sum(copies) if copies else F.count(F.lit(1)), unique_key)
    along = Window.partitionBy(*keys).orderBy("_month")
    covering = F.coalesce(F.sum("_delta").over(along.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    sums = sums.select(*keys, "_month", "_num", "_zeros", "_total", covering.alias("_cover"), F.lead("_month").over(along).alias("_next"))
    # months up to the next event are covered by as many intervals as this one
    steps = F.when(F.col("_cover") > 0, F.col("_next") - F.col("_month") - 1).otherwise(F.lit(0))
    # an event's own month takes the exact decimals; they are turned into doubles before the months are laid out
    full = F.when(F.col("_cover") > 0, _covered_us(F.col("_month")))
    num = F.when(F.col("_num").isNotNull(), F.col("_num") + F.coalesce(full, F.lit(0))).otherwise(full)
    sums = sums.select(*keys, num.cast("double").alias("_num"), "_zeros", "_total", "_cover", "_month", steps.alias("_steps"))
    # months without a part: no interval covers them either, so none follows that stays as they leave it
    return sums.where(F.col("_month").isNull() | F.col("_num").isNotNull() | F.col("_zeros").isNotNull())


def _months(sums: DataFrame, carry: list[str]) -> DataFrame:
    """The months of :func:`_steps` with their weights, and the columns ``carry``."""
    total = F.when(F.col("_total") != 0, F.col("_total"))
    share = F.col("_num") / total
    own = F.when(share.isNull() & F.col("_zeros").isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(share, F.lit(0.0)) + F.coalesce(F.col("_zeros").cast("double"), F.lit(0.0)))
    # an event's own weight is worked out once, before its months are laid out
    sums = sums.select(*carry, own.alias("_own"), total.alias("_total"), "_cover", "_month", "_steps")
    months = sums.select(*carry, "_own", "_total", "_cover", "_month", F.explode(F.sequence(F.lit(0), F.coalesce("_steps", F.lit(0)))).alias("_k"))
    months = months.select(*carry, "_own", "_total", "_cover", (F.col("_month") + F.col("_k")).alias("_number"), "_k")
    # the product of two doubles that are exact is the double nearest to the microseconds of all the intervals
    full = (F.col("_cover") * _month_days(F.col("_number"))).cast("double") * float(DAY_US)
    weight = F.when(F.col("_k") == 0, F.col("_own")).otherwise(full / F.col("_total"))
    return months.select(*carry, F.floor(F.col("_number") / 12).cast("int").alias("start_year"),
                         (F.col("_number") % 12 + 1).cast("int").alias("start_month"), weight.alias("weight"))


def month_weights(df: DataFrame, keys: Sequence[str], start: str, end: str, unique_key: bool = False,
                  copies: str | None = None) -> DataFrame:
    """Total weight per (key, year, month): the parts of all rows of a key that fall in one month.

    Equal intervals of a key are counted first. Months that an interval covers from end to end differ only in their
    number, so an interval adds its first and last part to their months, and one to a count of covering intervals from its
    second month on that ends with its last: three rows at most, however long it is. Summed by key and month, their running
    sum along a key's months says how many intervals cover each, and only then are the key's months laid out. The work is
    one row for each interval and for each month of a key; a key's running sum sees one row for each month with an event.
    ``copies`` names a column with the number of rows that a row of ``df`` stands for; with ``unique_key`` the caller says
    that every key has one row.

    The month's weight is computed as (its non-zero microseconds) / (key total) plus one per kept
    zero-length part -- equal to the sum of the part weights, but one exact division, so it does not
    depend on the order in which the parts are added. Rows with a null key are dropped.
    """
    keys = list(keys)
    return _months(_steps(df, keys, start, end, unique_key, copies), keys)


def key_steps(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """:func:`month_weights` before its months are laid out: one row for a key, to be joined and shuffled in their place.

    :func:`lay_out_steps` lays them out. A key's list has one entry for each month with an event.
    """
    keys = list(keys)
    events = _steps(df, keys, start, end, False, None)
    return events.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        F.collect_list(F.struct("_num", "_zeros", "_cover", "_month", "_steps")).alias("_events"))


def lay_out_steps(rows: DataFrame, carry: Sequence[str]) -> DataFrame:
    """A row of ``rows``, which holds the columns of :func:`key_steps`, for each month of its key, with the month's weight."""
    return _months(rows.select(*carry, "_total", F.inline("_events")), list(carry))
