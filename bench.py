"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from fleetgrid.plans import load
from fleetgrid.session import build_session

HEADLINE = [
    "match_same_cell", "match_nearest", "latest_driver_per_cell", "latest_per_driver", "ping_cells", "cell_of_point",
    "boundary_multicast", "dedup_last_timestamp", "cell_transitions", "partition_by_cell", "partition_by_point",
    "skew_max_over_mean", "copartition_check", "percentile_fixed_rank", "counter_rate", "moving_average_rate",
    "sustained_breach", "json_round_trip", "binary_prefixed_pings", "polygon_cells", "codec_report",
]
ROUNDS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()[0]
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    best: dict[str, float] = {}
    # whole rounds: the first one also warms the JVM up
    for _ in range(ROUNDS):
        for name in HEADLINE:
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best[name] = min(best.get(name, float("inf")), time.perf_counter() - began)
    timings = {name: round(seconds, 3) for name, seconds in best.items()}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "median": round(statistics.median(timings.values()), 3), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "pings": rows, "pings_per_sec": {n: round(rows / timings[n]) for n in ("ping_cells", "json_round_trip", "latest_per_driver", "dedup_last_timestamp")}}))
    spark.stop()


if __name__ == "__main__":
    main()
