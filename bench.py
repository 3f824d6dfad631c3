"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "w05_batter_rolling_table",
    "w05_pitcher_rolling_table",
    "w04_rolling_ratios_batter",
    "j04_asof_strict",
    "j05_latest_row_join",
    "j08_tiered_resolution",
    "j13_spine_assembly",
    "a03_batter_game_contact",
    "t04_keep_last",
    "w08_rank_within_slate",
    "b01_hr_view",
    "b08_outcome_mart",
    "b09_hr_board",
    "b12_nrfi_board",
    "b15_slate_selection",
    "io15_page_tokens",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    from slatework.catalog import registered
    from slatework.session import local_session

    spark = local_session("bench", cores=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    # One small run first: JVM and code generation start-up is not a query's cost.
    queries["a21_distinct_seasons"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(f"{seconds[name]:8.2f}s {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
