"""Sinks: full-refresh tables, plain or bucketed, and lazy views, the reference's two materialisations.

A table is written as Parquet under a folder the caller names -- on a cluster a shared store, never a machine-local
temporary folder -- and read back, so that everything downstream starts from the written files (lineage is cut; a lost
executor recomputes from them, not from the raw sources). A view is simply the lazy DataFrame.

A refresh writes beside the table and takes its place only when the write has succeeded: a job that fails on the way
leaves the table as it was. The old version is set aside first and goes last; should the job end between the two renames,
the next refresh or :func:`read_table` puts it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Beside the tables: versions being written, and versions set aside for the moment of the switch.
STAGING, ASIDE = "_staging", "_aside"


def table_location(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _move(spark: SparkSession, source: str, target: str) -> None:
    files, there = _files(spark, target)
    files.mkdirs(there.getParent())
    if not files.rename(_files(spark, source)[1], there):
        raise OSError(f"cannot move {source} to {target}")


def recover(spark: SparkSession, base: str, name: str) -> None:
    """Puts a table back that was set aside when its job ended before the new version took its place."""
    path, aside = table_location(base, name), table_location(base, f"{ASIDE}/{name}")
    files, where = _files(spark, path)
    if not files.exists(where) and files.exists(_files(spark, aside)[1]):
        _move(spark, aside, path)


def switch(spark: SparkSession, base: str, name: str, written: str) -> str:
    """Makes the files at ``written`` the table ``name``; returns its location."""
    path, aside = table_location(base, name), table_location(base, f"{ASIDE}/{name}")
    recover(spark, base, name)
    files, where = _files(spark, path)
    if files.exists(where):
        files.delete(_files(spark, aside)[1], True)
        _move(spark, path, aside)
    _move(spark, written, path)
    files.delete(_files(spark, aside)[1], True)
    return path


def _staged(base: str, name: str) -> str:
    return table_location(base, f"{STAGING}/{name}-{uuid.uuid4().hex}")


def write_table(df: DataFrame, base: str, name: str, partition_by: list[str] | None = None,
                max_records_per_file: int | None = None) -> DataFrame:
    """Full refresh of table ``name`` under ``base``; returns the table as read back, columns in the order of ``df``.

    Rows of a partitioned table are rebalanced by its partition columns first, so each of its folders gets few files of
    a useful size, and a large one several.
    """
    spark, staged = df.sparkSession, _staged(base, name)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(staged)
    return spark.read.parquet(switch(spark, base, name, staged)).select(*df.columns)


def write_bucketed(df: DataFrame, base: str, name: str, keys: list[str], buckets: int | None = None,
                   partition_by: list[str] | None = None) -> DataFrame:
    """Full refresh of table ``name``, its rows dealt to buckets by ``keys`` and sorted by them within each file.

    Read through the session's catalog, where the table is ``<name>_by_<keys>``, Spark knows where a key's rows lie: joins
    and aggregates on these keys take the table without shuffling it. ``buckets`` should be at least
    ``spark.sql.shuffle.partitions``, its default, or Spark may prefer to shuffle for more tasks. A key with very many rows
    is one bucket, as in any join on it; use :func:`write_table` where no later step joins on the keys.
    """
    spark, staged = df.sparkSession, _staged(base, name)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_by_{'_'.join(keys)}"
    fresh = f"{table}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys)  # one file for each bucket, in each folder of a partitioned table
    writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", staged)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(fresh)
    path = switch(spark, base, name, staged)
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")  # the catalog's entry alone: the files are the table's
    spark.sql(f"ALTER TABLE `{fresh}` RENAME TO `{table}`")
    spark.sql(f"ALTER TABLE `{table}` SET LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE `{table}`")
    return spark.table(table).select(*df.columns)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    recover(spark, base, name)
    return spark.read.parquet(table_location(base, name))
