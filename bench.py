"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlake.catalog.queries import QUERIES  # noqa: E402

HEADLINE = (
    "medallion_route_profitability", "dq_pk_uniqueness", "dq_first_failure", "dq_metrics",
    "fact_trips", "fact_fuel_purchases", "scd2_merge", "dim_truck", "driver_at_event",
    "view_trip_details", "view_monthly_fleet_metrics", "view_driver_scorecard",
    "view_route_profitability", "view_facility_turnaround", "measures_financial_by_year",
    "measures_by_customer_type_and_month", "measures_grand_total", "revenue_ytd",
    "revenue_prior_year", "fk_orphans", "profile_columns", "gold_clustered_layout",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("fleetlake-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
