"""Times the headline queries and prints one JSON line.

Each time covers building the plan and producing every row (no-op sink), and is the best of RUNS runs.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterloom.checks import registry  # noqa: E402

RUNS = 2

HEADLINE = (
    "grid_energy_curve",
    "grid_energy_curve_text",
    "grid_energy_curve_raw_ids",
    "grid_iv_curve_triphasic",
    "grid_iv_curve_monophasic",
    "iv_before_inspection",
    "energy_before_inspection",
    "indirect_extract",
    "interval_join_contract_tariff",
    "interval_join_equipment",
    "restrict_points_window_iv",
    "restrict_own_window",
    "restrict_daily_template",
    "pivot_max_magnitudes",
    "per_point_grid",
    "inspection_batches",
    "latest_inspection_triphasic",
    "point_history",
    "decode_iv_cells",
)


def main():
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def run(name):
        queries[name](spark, base).write.format("noop").mode("overwrite").save()

    run("pivot_max_magnitudes")  # start workers and load classes before timing
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            run(name)
            taken.append(time.perf_counter() - begin)
        times[name] = round(min(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(base.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
