"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores.
Each query runs once to warm up and then ``BENCH_RUNS`` times into the ``noop``
sink, which computes every row and stores none; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.plans.queries import registry  # noqa: E402
from roadpulse.session import build_session  # noqa: E402

HEADLINE = [
    "total_traffic_batch",
    "daily_traffic",
    "event_time_span",
    "window_traffic_30s_10s",
    "heatmap_daily",
    "heatmap_120s_10s",
    "poi_vehicles_live",
    "poi_multi_join",
    "poi_multi_join_salted",
    "poi_latest_per_vehicle",
    "first_sightings",
    "first_per_vehicle_batch",
    "total_traffic_running",
    "total_traffic_running_all_events",
    "json_roundtrip",
    "dead_letter_split",
    "latest_offsets",
    "view_latest_ranked",
    "traffic_pivot",
    "speed_features",
    "words",
    "longest_word",
    "word_count",
    "word_count_desc",
]
# Each of these starts queries or writes tables; they run once, after the rest.
ONCE = ["archive_pruned_scan", "speed_model_metrics", "stream_first_sightings", "stream_total_traffic"]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names or HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    for name in [] if names else ONCE:
        seconds[name] = round(run(name), 4)
    print(
        json.dumps(
            {
                "metric": "sum of median seconds, headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
