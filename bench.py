"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Nothing is shared between queries: each starts from the given tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from logwarden.checks import queries as checks
from logwarden.session import build_session

HEADLINE = (
    "s1_ndjson_scan",
    "p17_request_features",
    "a3_path_baseline",
    "a5_entity_windows",
    "a6_query_shapes",
    "j4_nearest_neighbours",
    "m4_lof_fit",
    "m7_calibration",
    "m10_train_candidate",
    "l5_url_alerts",
    "d6_combined_drift",
    "t2_score_batch",
    "t5_event_time_windows",
)
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the session
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            checks.reset()
            start = time.perf_counter()
            checks.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
