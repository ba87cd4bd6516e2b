"""Joins that bring per-key values back to rows, for keys that may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``per_key`` on ``keys``, null-safely: a null key part is one group, as in a window partition.

    A null-safe comparison is not the partitioning that an aggregate leaves behind, so Spark shuffles both sides for this
    join alone, and adaptive execution can split a hot key's rows over several tasks by where they came from -- equal
    rows included, whatever their content. Nothing here depends on how rows are laid out or on a size threshold.
    ``how`` is ``"inner"`` or ``"left"``.
    """
    named = per_key.select(*[F.col(c).alias(f"_pk_{keys.index(c)}") if c in keys else F.col(c) for c in per_key.columns])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_pk_{i}"))
    return rows.join(named, cond, how).drop(*[f"_pk_{i}" for i in range(len(keys))])


def join_on_keys(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` inner joined with ``per_key`` on ``keys`` that are strings or numbers (SQL equality: a null key never matches);
    the result stays dealt by ``keys``.

    As in :func:`join_per_key`, ``per_key`` is compared by an expression, so that it is shuffled for this join alone and
    adaptive execution can split a hot key's rows. The rows' own keys are plain columns: aggregates and windows by them need
    no shuffle of their own, unless a key has been split.
    """
    kinds = dict(per_key.dtypes)
    named = per_key
    for k in keys:
        named = named.where(F.col(k).isNotNull())
    named = named.select(*[F.col(c).alias(f"_pk_{keys.index(c)}") if c in keys else F.col(c) for c in named.columns])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        never = F.lit("") if kinds[k] == "string" else F.lit(0).cast(kinds[k])
        cond = cond & (F.col(k) == F.coalesce(F.col(f"_pk_{i}"), never))
    return rows.join(named, cond).drop(*[f"_pk_{i}" for i in range(len(keys))])


def existence_flags(rows: DataFrame, keyset: DataFrame, keys: list[str], flag: str = "_exists") -> DataFrame:
    """``rows`` with a boolean ``flag``: whether ``keyset`` has a row with the same key (SQL equality,
    so a null key part never matches, as in ``EXISTS``).

    The key set is de-duplicated first, a partial aggregate, so a key repeated in many of its rows crosses the shuffle
    once per task; hot keys of ``rows`` are split as in :func:`join_per_key`.
    """
    present = keyset.select(*keys).dropna("any").distinct().withColumn(flag, F.lit(True))
    return join_per_key(rows, present, keys, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
