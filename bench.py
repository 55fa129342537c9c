"""Benchmark the headline models.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

First lands the driver-derived landing tables once (the loader step, timed
separately as ``landing_sec``), then runs each model query on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS``
(default 3) timed runs. The staged and model plans are built once per application,
in the warm-up. M1-M6, M9 and M10 run from the landing tables; M7, M8 and the data
tests read the stored marts, whose build is timed as ``mart_build_sec``. Each run
executes the full plan into the ``noop`` sink. ``machine_sec`` is the time of a fixed Spark
job, by which runs on other machines can be compared; ``models_sec`` the sum of M1-M6,
M9 and M10, which have done the same work in every round. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "respondent_daily",          # M1
    "protein_items",             # M2
    "protein_source_estimates",  # M3
    "validation_cohort",         # M4
    "validation_summary",        # M5
    "cycle_trends",              # M6
    "mortality_rates_long",      # M7
    "source_rates_long",         # M8
    "flow_cohort",               # M9
    "flow_summary",              # M10
    "dq_report",                 # DQ1-DQ5
]


MODELS = HEADLINE[:6] + ["flow_cohort", "flow_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cohortlab.plans.queries import QUERIES
    from cohortlab.session import build_session

    spark = build_session(
        f"local[{cpus}]", app_name="cohortlab-bench", shuffle_partitions=cpus,
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def machine() -> float:
        t0 = time.perf_counter()
        spark.range(0, 200_000_000, 1, 4 * cpus).selectExpr("id % 1000 AS k", "id * id % 97 AS v").groupBy("k").sum("v").write.format(
            "noop").mode("overwrite").save()
        return time.perf_counter() - t0

    machine_sec = round(min(machine() for _ in range(3)), 4)

    # The loader step (landing tables written once per application) is timed
    # on its own; the model timings below read the landed tables.
    from cohortlab.sources.landing import drop_landed, landed_tables

    t0 = time.perf_counter()
    landed = landed_tables(spark, sf_dir)
    for table in landed:
        landed[table]
    landing_sec = round(time.perf_counter() - t0, 4)

    # The model-build job (M1-M6, M9, M10 stored as tables), timed on its own:
    # the reports and the data tests below read the stored marts.
    from cohortlab.plans.queries import stored_marts

    t0 = time.perf_counter()
    stored_marts(spark, sf_dir)
    mart_build_sec = round(time.perf_counter() - t0, 4)

    names = only or HEADLINE
    results: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 4)
    drop_landed(spark)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "models_sec": round(sum(t for n, t in results.items() if n in MODELS), 4),
        "machine_sec": machine_sec,
        "landing_sec": landing_sec,
        "mart_build_sec": mart_build_sec,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
