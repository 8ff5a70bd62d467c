"""Time the headline queries and print one JSON line.

Each query runs twice to warm up and then BENCH_RUNS times (default 3); its time is the median. Results
are produced in full, into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from weftmart.queries import REGISTRY
from weftmart.session import build_session

HEADLINE = (
    "y1_mart_build",
    "y3_dimension_warehouse",
    "y6_transaction_warehouse",
    "y7_dimension_deletes",
    "a1_group_by",
    "a2_distinct_count",
    "a11_last_row",
    "j1_left_join_chain",
    "j3_foreign_keys",
    "w1_upsert",
    "w1_upsert_delta",
    "w4_skip_unchanged",
    "k4_surrogate_keys",
    "o3_running_number",
    "m1_keyed_diff",
    "t3_key_report",
)

WARM_UPS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "weftmart-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        samples = [run(name) for _ in range(WARM_UPS + runs)]
        times[name] = round(statistics.median(samples[WARM_UPS:]), 3)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
