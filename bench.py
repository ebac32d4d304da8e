"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (full execution,
nothing collected): once to warm up, then three timed runs, of which the
median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import statistics
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rivulet.plans.catalog import QUERIES  # noqa: E402
from rivulet.session import get_session, size_shuffle_partitions  # noqa: E402

HEADLINE = [
    "unique_visitors", "page_views", "unique_visitors_bitmap", "unique_visitors_bitmap_shards", "unique_visitors_running",
    "hot_items", "hot_urls",
    "marketing_total", "marketing_by_channel", "ad_clicks_by_province", "ad_blacklist", "login_fail_warnings",
    "login_fail_bursts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in sys.argv[1:] if q in QUERIES] or HEADLINE
    spark = get_session(f"local[{cpus}]", "rivulet-bench", driver_memory="16g")
    size_shuffle_partitions(spark, os.path.join(sf_dir, "events.parquet"))
    times = {}
    for name in only:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # warm-up: JIT, Python workers, file listing
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
