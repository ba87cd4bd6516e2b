"""Spark session settings the library relies on.

Everything here is plain Spark configuration. The only semantic requirement is a UTC session time zone:
the reference works on timestamps without zone, and ``date_trunc`` on ``timestamp_ntz`` goes through the
session zone (it returns a zoned ``timestamp``), so any other zone would move month boundaries.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings a cluster job needs for the plans in this package: AQE re-plans joins from real sizes
# (small sides become broadcasts only when measured small), splits skewed join partitions and
# coalesces small shuffle partitions. The joins that bring per-key statistics back to the rows feed
# aggregations grouped by a superset of the join key, so by default AQE would keep a hot key's
# partition whole to preserve that partitioning; forcing the split trades one extra shuffle (only
# when skew is detected) for not running a hot key in a single task.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on to an existing session."""
    for key, value in BASE_CONF.items():
        if key in ("spark.ui.enabled",):
            continue  # static, only settable at start-up
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "periodix") -> SparkSession:
    """A local-mode session for tests and the benchmark."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PERIODIX_DRIVER_MEMORY", "16g"))
    )
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
