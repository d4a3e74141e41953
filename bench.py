"""Time the headline workloads; prints one JSON line.

Each query runs once to warm up (code generation, file footers) and then
`BENCH_RUNS` times (default 2); the best time counts. Results go to Spark's `noop`
sink, so every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from voltline.session import build_session
from voltline.workloads import QUERIES

HEADLINE = [
    "gap_check_hourly", "gap_check_many_series", "max_gap_check", "null_run_gaps",
    "watermark_append", "rolling_refetch_merge", "dedup_keep_last", "missing_parts",
    "interval_to_hourly", "interval_to_hourly_long", "monthly_capacity", "annual_capacity", "capacity_at_date",
    "potential_monthly", "fleet_capacity_factor", "historic_potential", "nearest_cell_weights",
    "country_area_weighted", "technology_blend", "country_product", "fleet_blend",
    "solar_unit_preparation", "capacity_events", "hourly_mean_speed",
    "json_block_series", "measure_csv", "quarter_hour_csv", "zone_csv_series", "grid_month_import",
    "delivery_blocks_to_utc", "footprint_hull",
]


def run(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(min(run(QUERIES[name], spark, folder) for _ in range(runs)), 4)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
