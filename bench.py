"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (sample folder), BENCH_CPUS (local threads), BENCH_RUNS.
Each query warms up until two runs agree within a tenth (four runs at most), then runs
BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from patronage.registry.queries import QUERIES
from patronage.session import build_session

HEADLINE = [
    "p3_clean_transactions",
    "p4_clean_items",
    "p6_clean_campaign_performance",
    "a1_rfm_metrics",
    "a1_rfm_metrics_fanout",
    "m5_rfm_segments",
    "a2_rfm_summary",
    "a3_campaign_metrics",
    "w1_campaign_ranks",
    "d4_campaign_display",
    "j5_star_join",
    "a11_journey_summary",
    "a12_ab_variant_totals",
    "a13_ab_summary",
    "a14_dq_summary",
    "unified_customers",
    "f28_revenue_lags",
    "f23_order_counts",
    "f13_clip_iqr",
    "t8_stratified_split",
    "t9_timeline_split",
    "d8_forecast_report",
    "j13_rule_segments",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "6g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str) -> float:
        start = time.perf_counter()
        # the noop sink computes every row and column without collecting them
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        last = timed(name)
        for _ in range(3):
            before, last = last, timed(name)
            if abs(last - before) <= 0.1 * before:
                break
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm, median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
