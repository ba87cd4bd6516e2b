"""Planned start of an operation: end minus its planned duration in (fractional) days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodix import labels
from periodix.functions import subtract_days


def plan_start(gandoper: DataFrame, project_type: str = labels.PROJECT,
               carry: Sequence[str] = ()) -> DataFrame:
    """Project-type operations with non-null Start, VolPlan and Fin, and their computed start date.

    ``start_date`` is ``Fin`` when ``DurPlanD`` is null, else ``Fin - DurPlanD days``. A narrow
    projection: the filter reaches the parquet scan. ``carry`` names extra source columns to keep.
    """
    rows = gandoper.where(
        (F.col("project_type") == project_type)
        & F.col("Start").isNotNull()
        & F.col("VolPlan").isNotNull()
        & F.col("Fin").isNotNull()
    )
    return rows.select(
        F.col("index").alias("gant_index"),
        F.col("Code").alias("code"),
        F.col("DurPlanD").alias("dur_plan_d"),
        F.col("Start"),
        F.col("Fin").alias("end_date"),
        F.col("VolPlan").alias("vol"),
        F.col("project_type"),
        F.col("object"),
        F.col("Calen"),
        F.when(F.col("DurPlanD").isNull(), F.col("Fin"))
        .otherwise(subtract_days(F.col("Fin"), F.col("DurPlanD")))
        .alias("start_date"),
        *carry,
    )
