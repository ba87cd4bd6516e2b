"""Sums of doubles in SQL that do not depend on the order of rows."""

from __future__ import annotations

_CUTS = ("67108864", "1", "0.00000001490116119384765625", "2.220446049250313e-16")


def exact_sum(expr: str, condition: str = "") -> str:
    """Sum of ``expr`` as a double, of the rows that meet ``condition`` if one is given.

    Whole numbers of 2**26, 1, 2**-26 and 2**-52 are summed apart, each exactly.
    """
    where = f" FILTER (WHERE {condition})" if condition else ""
    above = f"({expr})"
    sums = []
    for cut in _CUTS:
        below = f"(({expr}) % {cut}::DOUBLE)"
        sums.append(f"CAST(sum(CAST(({above} - {below}) / {cut}::DOUBLE AS HUGEINT)){where} AS DOUBLE) * {cut}::DOUBLE")
        above = below
    return f"(({sums[0]} + {sums[1]}) + ({sums[2]} + {sums[3]}))"
