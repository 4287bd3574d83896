"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma-separated names, or "all"). One warm-up run, then the median of the
timed runs, each with all rows written to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.plans.queries import QUERIES  # noqa: E402
from starmart.session import build_session  # noqa: E402


# one or two of each family: decode, messages, windows, sampling, tables, marts, lists, checks, streams
HEADLINES = [
    "decode_events", "message_roundtrip", "event_messages", "clean_flags", "quarantine_split",
    "latest_per_key", "dim_driver", "surrogate_keys", "upsert_replay", "upsert_written", "partitioned_facts",
    "driver_standings", "team_standings", "team_rank", "season_topk", "standings_top10", "pit_strategy",
    "compare_entities", "entity_stats", "star_join", "table_counts", "every_nth", "paired_duration",
    "constraint_report", "stream_upsert", "stream_standings",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session(
        "starmart-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        run(spark, name, sf_dir)
        timings[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
