"""Headline queries, warm, median of three runs. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from slotwise.session import local_session  # noqa: E402

# Report name -> registered query.
HEADLINE = {
    "activity": "activity_by_bucket",
    "gaps": "gaps",
    "health_distribution": "health_distribution",
    "risk_radar": "risk_radar",
    "hot_accounts": "hot_accounts",
    "collapse": "collapse_updates",
    "export_cold": "export_cold",
    "decode": "decode_obligations",
    "state_dump": "state_dump_run",
    "stream_ingest": "stream_ingest",
    "history_page": "history_page_seek",
    "key_history": "account_history_hot",
}
RUNS = 3


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", memory="16g")
    seconds = {}
    for report, name in HEADLINE.items():
        run_once(spark, name, folder)  # warm-up
        seconds[report] = round(statistics.median(run_once(spark, name, folder) for _ in range(RUNS)), 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
