"""Time the headline queries on the driver's tables; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8). Each query runs to completion through a no-op sink, so the
whole plan executes and nothing is collected to the driver. ``publish_all``
is the production job (``plans.run.run_all``): the full result written
once, partitioned by month, then the six published files and the population
file, into a fresh scratch folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressio.plans import catalog as C  # noqa: E402
from pressio.plans.run import run_all  # noqa: E402
from pressio.session import build_session  # noqa: E402
from pressio.sources import adapters as A  # noqa: E402

HEADLINE = [
    "full_result", "snapshot_labelled", "snapshot_map", "snapshot_scatter", "arrow",
    "weekly_wide", "daily_wide", "weighted_count", "vaccination_with_total",
    "lag_increment", "events_daily_wide",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def publish_all(spark, sf):
    """The batch job: P1 written once (partitioned by month), then the six
    published files and the population file, into a fresh scratch folder."""
    out = tempfile.mkdtemp(prefix="pressio-bench-")
    run_all(spark, A.incidence_raw(spark, sf), A.vaccination_raw(spark, sf),
            A.dimension_raw(spark, sf), out, C.CFG, population=A.population_raw(spark, sf))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="pressio-bench",
                          shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g",
                                 # local inputs are a few MB: let AQE keep several
                                 # small post-shuffle partitions so all cores work
                                 "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
                                 **json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}"))})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up on the smallest tables: JVM, class loading and code generation
    # caches, so the timings below are steady-state runs on the measured data
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run(C.QUERIES[name](spark, warm))
    run(C.QUERIES["dimension_with_total"](spark, sf))
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(C.QUERIES[name](spark, sf))
        times[name] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    publish_all(spark, sf)
    times["publish_all"] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
