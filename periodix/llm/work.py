"""Tables written to the shared folder: lineage ends there, so a lost executor costs one step."""

from __future__ import annotations

import contextlib
import hashlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def work_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    A session that runs on one machine (``local`` master) and has no such setting gets a temporary one; a
    cluster without it is an error, because executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="llm-work-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The rows of ``df``, written as Parquet under ``folder`` and read back."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """(doc_id): the ids of more than one row, and null where a row has no id."""
    ids = docs.groupBy(F.col(f"`{id_col}`").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    return ids.where("n > 1 or doc_id is null").select("doc_id")


def released(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over Arrow batches that gives freed memory back to the system when it ends, so that a worker which goes on
    to other stages does not keep the largest of each."""
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            import ctypes

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every system's C library can
                ctypes.CDLL(None).malloc_trim(0)
    return run


def map_arrow(rows: DataFrame, task: Callable[[Iterator], Iterator], schema: str | StructType) -> DataFrame:
    """``rows.mapInArrow`` with a task that is ``released``."""
    return rows.mapInArrow(released(task), schema)


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, component), the smallest id reached.

    In turns, every id takes the smallest label among its neighbours, then the label of its label. Both sides of each
    join are plain shuffles of a table, which AQE splits where one id has very many neighbours; minima combine before
    they are shuffled. The number of turns grows with the logarithm of a component's width. Ids without an edge are not
    returned.
    """
    there = edges.where("a <> b").select("a", "b")
    both = written(there.union(there.select("b", "a")).distinct(), folder, f"{name}-edges")
    label = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), folder, f"{name}-0")
    turn = 0
    while True:
        turn += 1
        own = label.select("id", "label", F.col("label").alias("old"))
        seen = both.join(label, both.b == label.id).select(F.col("a").alias("id"), "label", F.lit(None).cast("long").alias("old"))
        near = own.union(seen).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("high"), F.max("old").alias("old"))
        near = written(near, folder, f"{name}-{turn}-near")
        if near.where("old <> label").isEmpty():
            return label.select("id", F.col("label").alias("component"))
        # where two labels meet at an id, the larger one is itself relabelled
        hooks = near.where("high > label").select(F.col("high").alias("id"), "label")
        root = near.select("id", "label").union(hooks).groupBy("id").agg(F.min("label").alias("label"))
        up = root.select(F.col("id").alias("up"), F.col("label").alias("top"))
        label = written(root.join(up, F.col("label") == F.col("up"), "left").select("id", F.least("label", "top").alias("label")),
                        folder, f"{name}-{turn}")


#: Rows that Spark hands to Python at a time; whole texts make larger batches costly in memory.
BATCH_ROWS = 2000


def ship_package(spark: SparkSession) -> None:
    """Sends this library to the executors, as ``--py-files`` would, unless the session has it already, and bounds Arrow
    batches to ``BATCH_ROWS`` unless the session's bound is lower."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, str(BATCH_ROWS))
    root = Path(__file__).resolve().parents[1]
    sources = sorted(root.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:16]
    name = f"periodix-{digest}.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    path = Path(tempfile.mkdtemp(prefix="periodix-")) / name
    with zipfile.ZipFile(path, "w") as out:
        for p in [*(d for d in root.rglob("*") if d.is_dir() and d.name != "__pycache__"), *sources]:
            out.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
