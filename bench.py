"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of task threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from threadlytics.checks.queries import QUERIES
from threadlytics.session import get_session

HEADLINES = [
    "ticker_span",
    "extraction_confidence",
    "lexicon_hype",
    "likely_financial",
    "clean_json",
    "parse_responses",
    "extract_tickers",
    "best_mentions",
    "contextual_inheritance",
    "comment_depth",
    "parent_inheritance",
    "mentions_on_arrival",
    "extraction_summary",
    "ticker_totals",
    "running_ticker_hype",
    "ticker_leaderboard",
    "lineitem_leaderboard",
    "ticker_daily_stats",
    "backfill_daily",
    "upsert_posts",
    "upsert_mentions",
    "stream_mentions",
    "stream_ticker_totals",
    "score_with_stub",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="threadlytics-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("method_breakdown")
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
