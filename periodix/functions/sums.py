"""Sums of doubles that do not depend on the order in which values are added."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A value is cut at multiples of these; a sum of the parts between two of them has room for 2**37 values.
CUTS = (2.0**26, 1.0, 2.0**-26, 2.0**-52)


def _parts(x: Column) -> list[Column]:
    """A finite double as whole numbers of each cut, toward zero.

    Quotients and differences of doubles by powers of two are exact, so the parts add up to the value but for what lies
    below the last cut. A cast to a whole number costs a fraction of a remainder of doubles.
    """
    parts = []
    for c in CUTS:
        whole = (x / F.lit(c)).cast("long")
        parts.append(whole)
        x = x - whole.cast("double") * F.lit(c)
    return parts


def exact_sum(x: Column) -> Column:
    """Sum of a measure as a double, the same bits however rows are laid out.

    Each value is cut into four whole numbers, whose sums are exact; only the four totals are rounded, when they are put
    together. Values of magnitude 1 and more are cut exactly; of smaller ones what lies below 2**-52 goes, 2.3e-16 a value
    at most. A NaN gives NaN, infinities add up to themselves or to NaN. Values of 6e26 and more stop the job. Null
    without values. ``x`` appears several times: pass a column, not a long expression.
    """
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    high, ones, low, least = (F.sum(F.when(finite, p)).cast("double") * F.lit(c) for p, c in zip(_parts(x), CUTS))
    return F.coalesce(F.sum(F.when(~finite, x)), (high + ones) + (low + least))
