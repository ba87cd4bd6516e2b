"""Intermediate tables in the folder that the driver and all executors share.

A result that several readers must see alike, or that is expensive to compute again, is written once and read back: its
lineage ends there, so a lost executor costs one step and every reader sees the same rows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A session that runs on one machine (``local`` master) and has no such setting gets a temporary one; a cluster without
    it is an error, because executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="periodix-work-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fixed(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet under the shared folder and read back.

    Columns are numbered in the file, so any names will do. The table is the caller's session's to keep; its folder is
    ``<shared folder>/<name>-<id>``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).toDF(*df.columns)
