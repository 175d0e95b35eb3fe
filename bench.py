"""Time the headline queries: two warm-ups, then the median of three runs, as one JSON line."""

import json
import os
import statistics
import sys
import time

from checks import catalog
from stipend.session import local_session

HEADLINE = [
    "latest_batch_strict",
    "latest_batch_by_category",
    "export_batches",
    "batch_manifest",
    "interval_overlap_join",
    "absence_join",
    "payout_detail",
    "value_recode",
]
WARM_UPS = 2
RUNS = 3


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(WARM_UPS):
            seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cores": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
