"""Benchmark: run every registered query over the tables in $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row is produced, nothing is collected).
Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: seconds}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from periodix.catalog import REGISTRY  # noqa: E402
from periodix.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(REGISTRY)
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app_name="periodix-bench")
    # warm-up: JVM, parquet footers and code generation paths
    REGISTRY["plan_month_spread"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep measuring the others; report the failure in the JSON line
            timings[name] = None
            errors[name] = str(exc).splitlines()[0][:300]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    out = {"metric": "total_query_seconds", "value": round(sum(t for t in timings.values() if t is not None), 3),
           "unit": "sec", "queries": timings, "sf": sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
