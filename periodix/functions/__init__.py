"""Column helpers that give PostgreSQL results with built-in Spark expressions (no UDFs)."""

from periodix.functions.pgcompat import (  # noqa: F401
    add_months,
    concat_skip_nulls,
    is_false,
    is_true,
    micros_between,
    month_index,
    month_start,
    nullif,
    replace_first,
    round_half_even,
    strip_spaces,
    subtract_days,
    zero_pad_month,
)
