"""Times the headline queries and prints one JSON line.

Each query is run to completion into the no-op sink, after one untimed run;
the median of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "o01_load_csv",
    "o09_read_changes",
    "o13_snapshot_diff",
    "o20_dedupe_changes",
    "o22_latest_state",
    "o22_current_state",
    "o24_append_only_state",
    "o25_geolocation_unique",
    "o26_translate_category",
    "o27_merge_batch",
    "o28_apply_transition",
    "o34_random_top",
    "o36_price_or_default",
    "o37_dim_customers",
    "o39_fact_order_items",
    "o39_fact_orders",
    "o39_fact_payments",
    "o40_reconcile_payments",
    "o41_check_unique",
    "o43_check_fk",
    "o46_illegal_transitions",
    "o47_check_milestones",
    "o48_check_item_sequence",
    "o49_mix_profile",
    "o50_order_durations",
    "o55_upsert_stream",
    "o57_order_features",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app="tidemark-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else None,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
