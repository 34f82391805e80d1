"""Time the jobs over the test tables and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of local threads. Each query
is run once to warm up and then timed; the middle of three runs is taken. With BENCH_PLAIN=1, plans of a plain shape (groups
gathered per key, joins per count) are timed for comparison as `plain_*`.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from clickloom.plans.queries import all_queries  # noqa: E402
from clickloom.plans.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]


def seconds(query, spark) -> float:
    begin = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = all_queries()
    if os.environ.get("BENCH_PLAIN"):
        from benchmarks.plain_plans import plain_queries

        todo.update(plain_queries())
    times = {}
    for name, query in todo.items():
        if ONLY and name not in ONLY:
            continue
        seconds(query, spark)
        times[name] = round(statistics.median(seconds(query, spark) for _ in range(3)), 4)
    result = {
        "metric": "total time of all queries, warm",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
