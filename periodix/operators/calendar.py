"""Calendar-exception adjustment of month parts (optional; the reference computes it in a CTE that
no output uses, so it is off in every mart here and offered as a separate operator).

For a part whose start month equals an exception's start month on the same calendar, exception dates
are moved to the part's year by adding the day difference between the two 1 Januaries (so dates after
February drift by a day around leap years, as in the reference). A start inside the exception moves to
the exception's true end; an end inside it moves to the true end, or to the true start when the part
starts in another month. Parts on ``SR_``-pattern calendars starting in December to March are
removed. Exceptions are a small dictionary, joined on (month, calendar) -- broadcast when Spark
measures it small, which a calendar-exception list is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINTER_MONTHS = (1, 2, 3, 12)   # fixed values: months whose SR_ calendar parts are excluded
EXCLUDED_CALENDARS = "SR_%"     # fixed value: LIKE pattern ('_' is a wildcard, as in the reference)


def _moved(exception_day: Column, year_of: Column) -> Column:
    """The day of an exception in another date's year: as many days after 1 January as between the two 1 Januaries."""
    first = lambda c: F.make_date(F.year(c), F.lit(1), F.lit(1))
    return exception_day + F.make_dt_interval(F.datediff(first(year_of), first(exception_day)))


def adjust_calendar(parts: DataFrame, exceptions: DataFrame, start: str = "part_start", end: str = "part_end",
                    calendar: str = "Calen") -> DataFrame:
    """Parts with ``start_date`` / ``end_date`` adjusted for calendar exceptions.

    ``parts`` carries ``start``, ``end`` and ``calendar``; ``exceptions`` has Calen_Code, Start, Fin,
    Start_true, Fin_true. Other columns of ``parts`` are kept; the part bounds are replaced.
    """
    # null calendars and starts are in no winter: such parts stay
    winter = F.coalesce(F.col(calendar).like(EXCLUDED_CALENDARS) & F.month(start).isin(*WINTER_MONTHS), F.lit(False))
    rows = parts.where(~winter)
    ex = exceptions.select(*[F.col(c).alias(f"_x_{c}") for c in ("Calen_Code", "Start", "Fin", "Start_true", "Fin_true")])
    met = rows.join(ex, (F.month(start) == F.month("_x_Start")) & (F.col(calendar) == F.col("_x_Calen_Code")), "left")
    s, e = F.col(start), F.col(end)
    # an exception's span begins in the year of the part's start and ends in that of its end
    span = (_moved(F.col("_x_Start"), s), _moved(F.col("_x_Fin"), e))
    one_month = F.month(s) == F.month(e)
    end_inside = e.between(*span) & (F.month(e) == F.month("_x_Fin"))
    new_start = F.when(s.between(*span), _moved(F.col("_x_Fin_true"), e)).otherwise(s)
    new_end = F.when(end_inside, _moved(F.when(one_month, F.col("_x_Fin_true")).otherwise(F.col("_x_Start_true")), s)).otherwise(e)
    kept = [c for c in parts.columns if c not in (start, end)]
    return met.select(*kept, new_start.alias("start_date"), new_end.alias("end_date"))
