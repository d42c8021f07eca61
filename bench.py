"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES (comma separated, or "all") the queries.
Every query is run whole into the no-op sink; BENCH_REPEAT (default 1) timed runs follow one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.registry import CASES  # noqa: E402
from tidemark.session import local_session, release  # noqa: E402

HEADLINES = (
    "calendar_reindex",
    "ffill_unlimited",
    "fill_by_age",
    "asof_join",
    "last_positive_before_month",
    "rolling_mean",
    "rolling_median",
    "rolling_correlation",
    "rolling_correlation_levels",
    "cumulative_sum_max",
    "all_changes",
    "analysis_with_statistics",
    "percentile_zscore",
    "growth_rates",
    "correlation_snapshot",
    "valuation_ratios",
    "reserve_risk",
    "power_law",
    "metcalfe",
    "hash_ribbons",
    "energy_value",
    "market_cap",
    "drawdowns",
    "cycle_lows",
    "event_eras",
    "indexed_history_ytd",
    "roi_table",
    "monthly_heatmap",
    "ytd_comparison",
    "price_buckets_1k",
    "fundamentals_table",
    "performance_combined",
    "candle_summary",
    "query_models_latest",
    "check_network",
    "source_merged_chunks",
    "pipeline_base_panel",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(CASES) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINES)
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        CASES[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent = time.perf_counter() - start
        release()  # no query reads what another one has computed
        return spent

    run("rolling_median")  # warm-up of the JVM, the Python workers and the file cache
    seconds = {name: round(min(run(name) for _ in range(repeat)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
