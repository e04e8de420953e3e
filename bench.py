"""Time the headline queries: one warm-up, then the median of three runs, into a sink that drops the rows.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8), BENCH_RUNS (3), BENCH_ONLY (name prefixes).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_weekly_features",
    "landing_daily_macro",
    "landing_monthly_macro",
    "landing_sector_daily",
    "slice_weekly_pivot",
    "w03_interpolate_carry",
    "w05_interpolate_steps",
    "w11_rolling_z",
    "w24_market_features",
    "j08_upsert",
    "n02_upsert_raw_news",
    "n05_relevance_mart",
    "n08_news_digest",
    "r04_j12_composite",
    "a10_null_profile",
    "a11_describe",
    "a19_corr_matrix",
    "a28_quality_report",
    "w16_lag_corr",
    "t04_dickey_fuller",
    "p07_incremental",
    "c02_ensemble",
    "m08_forecast_metrics",
    "g03_k03_best_run",
    "k04_top_n_per_key",
]


def main() -> None:
    from tidemark.session import build_session
    from workload import QUERIES

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    chosen = [n for n in (QUERIES if only else HEADLINE) if not only or any(n.startswith(p) for p in only)]
    seconds = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_seconds_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
