"""The stateless month spread runs on a streaming source and gives the batch result."""

import os
import shutil
import tempfile

from periodix.sources.bindings import World
from periodix.sources.tables import SCHEMAS
from periodix.streaming import plan_spread_stream, start_plan_spread
from tests.conftest import SF_SMALL


def test_plan_spread_on_stream(spark):
    scratch = tempfile.mkdtemp(prefix="periodix-stream-")  # a new folder per run
    src = os.path.join(scratch, "orders")
    os.makedirs(src)
    shutil.copy(os.path.join(SF_SMALL, "orders.parquet"), os.path.join(src, "part-0.parquet"))
    w = World(spark, SF_SMALL)
    batch_rows = plan_spread_stream(w.gandoper).count()
    w_stream = World(spark, SF_SMALL)
    w_stream.t._cache["orders"] = spark.readStream.schema(SCHEMAS["orders"]).parquet(src)
    q = start_plan_spread(w_stream.gandoper_project, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    assert spark.read.parquet(os.path.join(scratch, "out")).count() == batch_rows > 0
