"""The plan month spread over a streaming source of operations.

With one row per operation key the spread is row-local (a filter, an explode and a projection), so
the same plan runs on a streaming DataFrame with no state: each micro-batch of new operations yields
its month rows, appended to the sink. Operations whose rows can repeat need the keyed form and
belong in a batch build (:mod:`periodix.plans.build`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from periodix import labels as L
from periodix.plans.plan_fact import plan_by_month


def plan_spread_stream(operations: DataFrame, project_type: str = L.PROJECT) -> DataFrame:
    """Month rows for a stream (or batch) of operations with one row per (index, Code)."""
    return plan_by_month(operations, unique_key=True, project_type=project_type)


def start_plan_spread(operations: DataFrame, sink_path: str, checkpoint_location: str,
                      available_now: bool = True) -> StreamingQuery:
    """Append the month rows of new operations to a parquet sink, exactly once per file of input.

    ``checkpoint_location`` must be on shared storage on a cluster (it holds the stream's progress).
    """
    writer = (plan_spread_stream(operations).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_path)
