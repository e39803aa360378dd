"""Benchmark of the headline plans. Prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each plan runs to completion into Spark's ``noop`` sink (no collect to the driver); the value per
query is the median wall time of the runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedmart.session import get_session, scratch_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", app="feedmart-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})

    from feedmart.operators import core, ingest, keys, mart, windows
    from feedmart.plans.load import full_load
    from feedmart.plans.registered import EVENTS_AS_OF, ORDERS_AS_OF, RSS_AS_OF
    from feedmart.schemas import NEWS, RAW_ORDER, SOURCES, TAGS
    from feedmart.sources import testdata as td
    from feedmart.sources.rss import read_landing

    def empty(schema):
        return spark.createDataFrame([], schema)

    landing = td.write_rss_orders_landing(spark, sf_dir, scratch_path(spark, "bench-landing"))

    def core_load_events():
        raw = td.raw_events(spark, sf_dir)
        sources = core.new_sources(raw, empty(SOURCES))
        tags = core.new_tags(raw, empty(TAGS))
        return core.new_news_rows(raw, empty(NEWS), sources, tags)

    def surrogate_keys_lineitem():
        first = keys.first_per_key(td.raw_lineitem(spark, sf_dir), ["id"], RAW_ORDER,
                                   ["title", "link", "summary", "published", "source", "tags"])
        return keys.dense_ids(first, RAW_ORDER, "new_id")

    plans = {
        "mart_orders": lambda: mart.mart(td.fact_orders(spark, sf_dir), ORDERS_AS_OF),
        "mart_events": lambda: mart.mart(td.fact_events(spark, sf_dir), EVENTS_AS_OF),
        "mart_events_corrected": lambda: mart.mart(td.fact_events(spark, sf_dir), EVENTS_AS_OF, compat=False),
        "raw_explode_orders": lambda: ingest.to_raw(ingest.classify(td.rss_orders(spark, sf_dir), "full"), 0),
        "delta_explode_orders": lambda: ingest.to_raw(
            ingest.classify(td.rss_orders(spark, sf_dir), "delta", RSS_AS_OF), 1),
        "landing_scan_explode": lambda: ingest.to_raw(ingest.classify(read_landing(spark, landing), "full"), 0),
        "core_load_events": core_load_events,
        "surrogate_keys_lineitem": surrogate_keys_lineitem,
        "window_forms_orders": lambda: windows.day_count(windows.category_total(td.fact_orders(spark, sf_dir))),
        "init_load_orders": lambda: full_load(spark, landing, scratch_path(spark, "bench-store"), as_of=ORDERS_AS_OF),
    }

    results = {}
    for name, build in plans.items():
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                times.append(dt)
        results[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "runs": runs,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
