"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4) and
BENCH_REPEATS (default 1; the median counts) steer the run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from glyphlane.plans import load_queries
from glyphlane.plans.registry import Tables
from glyphlane.session import build_session

HEADLINE = [
    "chat_conversion", "log_counters", "resize_plan", "frame_plan", "sample_costs", "packing_report",
    "label_masks", "question_accuracy", "category_scores", "detection_metrics", "code_tallies",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "glyphlane.spread": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "7g")})
    spark.sparkContext.setLogLevel("ERROR")
    tables, known = Tables(spark, folder), load_queries()
    tables.region.collect()  # the session's own start is not a query's time
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            begin = time.perf_counter()
            known[name].build(tables).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
