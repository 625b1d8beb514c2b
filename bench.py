"""Time every registered query; prints one JSON line.

Settings: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (timed
runs after one warm-up; the fastest counts). Arguments name the queries to run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from daytally.plans.registry import queries
from daytally.settings import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, query) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=str(CPUS),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    times = {}
    for name in sys.argv[1:] or known:
        seconds(spark, known[name])
        times[name] = round(min(seconds(spark, known[name]) for _ in range(RUNS)), 3)
    scale = re.search(r"sf([\d.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
