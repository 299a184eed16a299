"""Wall time of the registered queries; prints one JSON line.

    BENCH_SF_DIR   data folder            (default /root/testdata/sf0.1)
    BENCH_CPUS     local executor threads (default: all)
    BENCH_QUERIES  comma-separated names  (default: the headline set below)
    BENCH_RUNS     runs of each query, of which the median counts (default 3)
    BENCH_INPUTS   "stored": what reports read is derived and stored before the clock starts (default);

No further run of a query begins once it has taken 30 seconds. The skewed set is shown beside the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import REGISTRY, reports  # noqa: E402
from wintide.session import build_session  # noqa: E402

HEADLINE = [
    "first_order_after_win",
    "first_last_event",
    "latest_per_key_with_ties",
    "latest_per_key_single",
    "latest_snapshot_rows",
    "scd2_as_of_ship_date",
    "scd2_as_of_by_slice",
    "state_at_win",
    "dominant_priority",
    "quota_cut_by_region",
    "product_mix",
    "typed_counts_and_sums",
    "weighted_levels",
    "membership_flags",
    "tenure_window_sums",
    "cohort_windows",
    "funnel_cohorts",
    "trailing_year",
    "owner_hierarchy",
    "account_360_view",
    "group_totals",
    "two_level_aggregation",
    "smb_accounts_today",
    "smb_accounts_at_win",
    "smb_account_expansions",
    "mm_accounts_granular",
    "mm_expansions_granular",
    "mm_expansions_by_type",
    "mm_expansion_windows",
    "mm_instance_months",
    "mm_leads_to_accounts",
    "account_overview",
    "account_360_full",
    "cross_sell_target_list",
    "product_target_list",
]


SKEWED = ["scd2_as_of_hot_key"]
ENOUGH = 30.0


def seconds_of(name: str, spark, folder: str, runs: int) -> float:
    taken: list[float] = []
    while len(taken) < runs and sum(taken) < ENOUGH:
        begin = time.perf_counter()
        frame = REGISTRY[name][0](spark, folder)
        frame.write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - begin)
    print(f"{name} {[round(s, 2) for s in taken]}", file=sys.stderr)
    return round(statistics.median(taken), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", 3))
    stored = os.environ.get("BENCH_INPUTS", "stored") == "stored"
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    begin = time.perf_counter()
    if stored:
        reports.prepare(spark, folder)
    preparation = round(time.perf_counter() - begin, 3)
    seconds = {name: seconds_of(name, spark, folder, runs) for name in names}
    skewed = {} if chosen else {name: seconds_of(name, spark, folder, runs) for name in SKEWED}
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "skewed": skewed,
        "runs": runs,
        "inputs": "stored" if stored else "derived",
        "storing_inputs_sec": preparation,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
