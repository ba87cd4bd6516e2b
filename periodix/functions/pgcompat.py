"""PostgreSQL-compatible column expressions.

Each helper maps one PostgreSQL behaviour the reference depends on to Spark built-ins, so the whole
plan stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_skip_nulls(*parts) -> Column:
    """PostgreSQL ``concat``: null arguments are skipped, the result is never null (trap T1)."""
    return F.concat_ws("", *[_c(p) for p in parts])


def round_half_even(x) -> Column:
    """PostgreSQL ``round(double)``: ties to even (trap T2). Spark ``round`` goes away from zero."""
    return F.rint(_c(x))


def replace_first(x, literal: str, replacement: str = "") -> Column:
    """PostgreSQL ``regexp_replace(s, pattern, r)`` without the 'g' flag: first match only (trap T3).

    The literal is matched as a plain string; the lazy prefix keeps everything before the first hit.
    """
    escaped = "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in literal)
    return F.regexp_replace(_c(x), "^((?s).*?)" + escaped, "$1" + replacement.replace("$", "\\$"))


def strip_spaces(x) -> Column:
    """``replace(s, ' ', '')``."""
    return F.replace(_c(x), F.lit(" "), F.lit(""))


def month_start(x) -> Column:
    """``date_trunc('month', ts)`` kept as ``timestamp_ntz`` (trap T5; needs a UTC session)."""
    return F.date_trunc("month", _c(x)).cast("timestamp_ntz")


def add_months(x, n) -> Column:
    """``ts + interval 'n month'`` on ``timestamp_ntz``, clamping the day like PostgreSQL."""
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return _c(x) + F.make_ym_interval(F.lit(0), n.cast("int"))


def month_index(x) -> Column:
    """Months since year 0: difference of two of these is the calendar-month distance."""
    x = _c(x)
    return F.year(x) * 12 + F.month(x)


def micros_between(start, end) -> Column:
    """``end - start`` in whole microseconds (exact integer arithmetic)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def subtract_days(ts, days) -> Column:
    """``ts - interval '1 day' * days`` for fractional days, rounded to the microsecond."""
    micros = F.round(_c(days) * 86400000000.0).cast("long")
    return F.timestamp_add("MICROSECOND", -micros, _c(ts))


def is_true(x) -> Column:
    """SQL ``x IS TRUE``: null gives false."""
    return _c(x).eqNullSafe(F.lit(True))


def is_false(x) -> Column:
    """SQL ``x IS FALSE``: null gives false."""
    return _c(x).eqNullSafe(F.lit(False))


def nullif(x, value) -> Column:
    """SQL ``nullif(x, value)`` (guards division, trap T7)."""
    x = _c(x)
    return F.when(x == F.lit(value), F.lit(None)).otherwise(x)


def zero_pad_month(month) -> Column:
    """The mart's two-character month text; a null month gives '0' (null-skipping concat)."""
    text = _c(month).cast("string")
    return F.when(F.length(text) == 2, text).otherwise(concat_skip_nulls(F.lit("0"), text))
