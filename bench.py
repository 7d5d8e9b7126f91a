"""Benchmark the headline queries.

Runs each query on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1): one warm-up, then three timed runs, median seconds.
A run executes the whole plan into Spark's ``noop`` sink (nothing is
collected).  Every query of the reconciliation catalogue is timed.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saletrace.plans.catalog import QUERIES  # noqa: E402
from saletrace.session import build_session  # noqa: E402

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="saletrace-bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.local.dir": scratch})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoint")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in (only or QUERIES):
        try:
            run(name)  # warm-up
            timings[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
        except Exception as e:  # noqa: BLE001 - report the failure, time the rest
            timings[name] = None
            errors[name] = str(e).splitlines()[0][:300]
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    total = round(sum(v for v in timings.values() if v is not None), 3)
    out = {"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
           "queries": timings, "sf": sf, "cpus": cpus, "reps": reps}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
