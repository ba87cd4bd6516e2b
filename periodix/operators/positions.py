"""Contract positions: a display label and a uniqueness key per price-list row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodix import labels as L
from periodix.functions import concat_skip_nulls

SEPARATOR = "    "  # fixed value: four spaces between cipher and name / object


def contract_positions(vdc: DataFrame) -> DataFrame:
    """Price list with ``Позиция из КВ`` = cipher + 4 spaces + name and ``unique_test`` = cipher +
    4 spaces + object. Null parts are skipped, never nulling the whole label. Narrow projection."""
    cipher = F.col(L.COL_CIPHER)
    return vdc.select(
        F.col(L.COL_WORK_NAME),
        cipher,
        F.col(L.COL_CONTRACT_SMR),
        F.col("object"),
        F.col(L.COL_VOLUME),
        F.col(L.COL_UNITS),
        concat_skip_nulls(cipher, F.lit(SEPARATOR), F.col(L.COL_WORK_NAME)).alias(L.COL_POSITION),
        concat_skip_nulls(cipher, F.lit(SEPARATOR), F.col("object")).alias("unique_test"),
        F.col(L.COL_UNIT_PRICE),
    )
