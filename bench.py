"""Time every query of the library and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads, BENCH_RUNS the timed runs.
Each query runs once to warm up; its figure is the median of the timed runs. After
BENCH_WARM_SECONDS queries run without warm-up; they are listed as cold.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from perennial import build_session
from perennial.plans.queries import QUERIES


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "perennial-bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    figures, cold = {}, []
    until = time.monotonic() + float(os.environ.get("BENCH_WARM_SECONDS", "600"))
    for name in sys.argv[1:] or QUERIES:
        if time.monotonic() < until:
            run(spark, name, sf_dir)
        else:
            cold.append(name)
        figures[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(figures.values()), 3),
                "unit": "sec",
                "queries": figures,
                "cold": cold,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
