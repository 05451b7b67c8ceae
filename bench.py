"""Time the headline queries on the test tables and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads.
Each query runs from the raw tables to its full result, which goes to Spark's
``noop`` sink.  A query runs BENCH_RUNS times (default 2), plan building included,
and the fastest run counts.  ``BENCH_ALL=1`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from listenlake.plans import medallion, registry
from listenlake.session import get_session, work_dir
from listenlake.sources import testdata

HEADLINE = [
    "silver_events", "silver_quarantine", "top_songs", "user_engagement", "artist_performance",
    "churn_risk", "country_stats", "peak_hours", "playlist_conversion", "user_loyalty",
    "dim_users", "dim_songs", "dim_date", "daily_plays", "dq_report", "forecast_metrics",
    "landing_clean", "bronze_load_twice", "gold_build", "stream_zones_single_scan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 1)
    spark = get_session(
        "listenlake-bench",
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry.queries()
    names = list(known) if os.environ.get("BENCH_ALL") else [n for n in HEADLINE if n in known]
    runs = int(os.environ.get("BENCH_RUNS") or 2)
    seconds: dict[str, float] = {}

    def query(name: str) -> None:
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def build_as_views(_: str) -> None:
        """Store silver, run the quality gate and publish every mart as a view."""
        bronze = testdata.bronze(spark, sf_dir)
        medallion.build_lake(spark, bronze, work_dir(spark, "bench"), "bench", registry.AS_OF)

    for name in [*names, "build_as_views"]:
        job = build_as_views if name == "build_as_views" else query
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            job(name)
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "listening analytics, total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
