"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

run once beforehand, untimed, so that the figures do not measure the JVM's start.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cyclograph.session import work  # noqa: E402
from cyclograph.workload import QUERIES  # noqa: E402

HEADLINES = {
    "incident_batch_clean_write_verify": "snk1_snk2_verified_write",
    "incident_fact": "prj7_incident_facts",
    "trip_fact": "prj8_trip_facts",
    "trip_files_load": "src2_src3_monthly_trip_files",
    "area_seed": "src7_prj11_areas",
    "calendar": "cal37_ag9_jn4_project_dates",
    "date_dimension": "cal30_date_dimension",
    "fiscal_periods": "cal33_wn11_fiscal_periods",
    "station_dimension": "ag7_ag8_wn2_stations",
    "station_day_mart": "ag3_station_day",
    "model_build": "dq_contract_outcomes",
    "correlation": "ag4_ag5_ag6_ag16_correlation",
    "regression_weights": "ml2_ml4_weights",
    "regression_evaluation": "ml3_evaluation",
    "regression_predictions": "ml5_predictions",
    "unique_check": "dq39_dq95_values_unique",
    "fused_check_suite": "dq_suite_one_pass",
    "ordered_check": "dq31_wn4_values_increasing",
    "partition_pruning": "snk5_partitioned_mart",
    "stream_batch": "str2_str6_fresh_status",
    "monthly_series_panel": "q5_jn7_monthly_series",
    "station_heatmap_panel": "q4_jn6_tk3_busy_station_hours",
    "top_areas_panel": "q1_jn5_tk1_top_areas",
}


WARM_UP = ("prj2_clean_incidents", "ag3_station_day")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cyclograph-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for label, name in HEADLINES.items():
        with work(spark):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[label] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
