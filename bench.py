"""Headline timings as one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores (default 8).
Every query is run to completion into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from idweave.catalog import feed  # noqa: E402
from idweave.catalog.queries import QUERIES  # noqa: E402
from idweave.plans import runs  # noqa: E402
from idweave.plans.scratch import scratch_tables  # noqa: E402
from idweave.plans.tables import buckets_for  # noqa: E402

HEADLINE = [
    "dedupe_events",
    "explode_merged",
    "new_identifiers_this_run",
    "new_identities_this_run",
    "id_mapping_this_run",
    "id_changes_this_run",
    "identifier_mapping_this_run",
    "point_in_time",
    "point_in_time_fixed",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("idweave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = feed.raw_events(spark, sf_dir)
    raw.count()  # start the JVM's compilers and the file cache, outside the timings

    times = {}
    for name in HEADLINE:
        query = QUERIES[name]
        times[name] = timed(
            lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    store = scratch_tables(spark, "bench-full", buckets_for(raw.count()))
    times["full_refresh"] = timed(lambda: runs.execute(store, feed.CONFIG, raw, feed.WHOLE))
    store = scratch_tables(spark, "bench-batches", buckets_for(raw.count()))
    for n, run in enumerate(feed.BATCHES, start=1):
        times[f"batch_{n}"] = timed(lambda r=run: runs.execute(store, feed.CONFIG, raw, r))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "identity_tables_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
