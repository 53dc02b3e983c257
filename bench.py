"""Benchmark the headline queries.

Runs each headline query of ``plans.catalog.HEADLINE`` on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8): one
warm-up run, then ``$BENCH_RUNS`` timed runs (default 3), median reported.  A
run is the full query from the parquet scan to the last row, executed with the
``noop`` sink so no rows travel to the driver.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scholarmetrics-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        # one local session: its checkpoints may lie in a folder of its own
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-checkpoints-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from scholarmetrics.plans.catalog import HEADLINE, QUERIES

    parts: list[str] = []

    def plan(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    def noting(method):
        def run(self, *args, **kw):
            parts.append(plan(self))
            return method(self, *args, **kw)

        return run

    kind = type(spark.range(1))
    kind.checkpoint, kind.persist = noting(kind.checkpoint), noting(kind.persist)

    times: dict[str, float] = {}
    plans: dict[str, dict[str, int]] = {}
    for name in HEADLINE:
        fn = QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        # host-independent figures beside the times: scans and shuffles of all plans of a
        # run, those of checkpointed tables and of a fit's input included
        del parts[:]
        parts.append(plan(fn(spark, sf_dir)))
        text = "\n".join(parts)
        plans[name] = {"scans": len(re.findall(r"FileScan|Scan ExistingRDD", text)), "shuffles": len(re.findall(r"(?<!Broadcast)Exchange ", text)), "plans": len(parts)}
        run()  # warm-up (JIT, file listing cache)
        times[name] = round(statistics.median(run() for _ in range(runs)), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "plans": plans,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
