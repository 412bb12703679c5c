"""Benchmark: the full layered run (the workload the reference publishes a
time for) plus the headline catalogue queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. ``value`` is the full bronze -> gold run in seconds;
``queries`` holds every timed item (each catalogue query executed completely
with a no-op sink: every column computed, nothing collected to the driver)
and the phases of the full run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sales_costed_asof",
    "inventory_valued_asof",
    "inventory_turnover_topn",
    "stockout_streaks",
    "streak_sensitivity",
    "zero_days_by_store",
    "mom_growth_by_channel",
    "negative_margin_product",
    "negative_margin_product_store",
    "quality_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerloom.plans.catalog import queries
    from ledgerloom.plans.layers import run_layers
    from ledgerloom.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="ledgerloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()

    # JVM / codegen warm-up on the smallest tables (not timed)
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm) and warm != sf_dir:
        run_layers(spark, warm, stop_on_error=False)
        for name in HEADLINE:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t = time.perf_counter()
    run = run_layers(spark, sf_dir, stop_on_error=False)
    full = round(time.perf_counter() - t, 3)
    times["full_run_bronze_to_gold"] = full
    times.update({f"full_run.{k}": v for k, v in run.seconds.items()})

    for name in HEADLINE:
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "full_run_bronze_to_gold_sec",
                "value": full,
                "unit": "sec",
                "queries": times,
                "sum_headline_query_sec": round(sum(times[n] for n in HEADLINE), 3),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
