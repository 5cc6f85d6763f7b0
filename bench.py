"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS (default 8) is the
number of local threads. A query's time covers building, planning and running it in full; it
is the better of two runs, the first of which compiles code. Both are reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from gridtally.session import build_session  # noqa: E402

HEADLINE = [
    "hourly_demand",
    "hourly_generation",
    "hourly_price",
    "hourly_flow",
    "residual_demand",
    "time_map",
    "padded_year",
    "rolling_horizons",
    "plant_table",
    "model_dispatch",
    "model_price",
    "exogenous_series",
    "storage_net_output",
    "mean_price_daily",
    "network_flows",
    "priced_flows",
    "link_flows_daily",
    "region_balance_daily",
    "link_revenue",
    "generation_daily",
    "generation_annual",
    "load_weighted_price_daily",
    "load_weighted_price_period",
    "results_summary",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "hourly_price", sf_dir)  # start-up is not part of any query
    names = sys.argv[1:] or HEADLINE
    runs = {name: [round(run(spark, name, sf_dir), 3) for _ in range(2)] for name in names}
    spark.stop()
    seconds = {name: min(times) for name, times in runs.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": {name: times[0] for name, times in runs.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
