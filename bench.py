"""Times the headline queries: one warm-up, then the median of the timed runs.

Every query runs to the end, its rows discarded on the executors.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks import load
from tripmill.session import build_session

HEADLINE = [
    "a5_monthly_fares",
    "a8_exact_quantiles",
    "a11_cluster_statistics",
    "a16_crosstab_percent",
    "a21_quality_report",
    "d5_top_zones",
    "d7_route_inequality",
    "e2_classification_report",
    "e8_compare_models",
    "e9_silhouette",
    "f27_training_features",
    "f28_study_features",
    "j4_attach_zones",
    "m6_stratified_split",
    "m9_clustering_features",
    "p2_trim_upper",
    "p3_trim_two_sided",
    "s19_ingest_table",
    "t4_sample_rows",
    "u5_union_with_times",
    "v1_error_histogram",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "5g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    checks = load()

    def once(name: str) -> float:
        start = time.perf_counter()
        checks[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
