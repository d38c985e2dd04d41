"""Skew and partitioning check on multi-file inputs with hot keys.

Usage: python scripts/scale_check.py [sf_dir] [files]

The driver tables are single files, so every local scan is one task. This
script derives (with Spark, from those tables) multi-file inputs in which
one key holds a third of all rows:

* listings: ``files`` Parquet files, typed; every third listing is in the
  same neighbourhood, and another third has the same price text;
* reviews: ``files`` Parquet files; every third review is the same row.

It then runs the cleaning (exact quantiles), Q1-Q3, the full-row dedup, the
duplicate count and the keyed dedup with Spark's event log in a scratch
folder, and prints per query: tasks, longest / median task time, shuffle
records written, and the most shuffle records read by one reduce task. The
last figure shows whether the hot key reached a single task whole: with
map-side partial aggregation it arrives as one record per map task.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from brightwash.operators import analytics, dedup  # noqa: E402
from brightwash.operators.types import convert_types  # noqa: E402
from brightwash.config import LISTING_TYPES  # noqa: E402
from brightwash.plans.clean import clean_listings, clean_reviews  # noqa: E402
from brightwash.session import build_session, scratch_dir  # noqa: E402
from brightwash.sources import testdata, write_parquet  # noqa: E402

_spec = importlib.util.spec_from_file_location(
    "plan_report", os.path.join(os.path.dirname(os.path.abspath(__file__)), "plan_report.py")
)
plan_report = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(plan_report)


def reduce_side(events, group):
    """Shuffle records written, and the most records read by one task."""
    jobs = [e for e in events if e["Event"] == "SparkListenerJobStart"
            and (e.get("Properties") or {}).get("spark.jobGroup.id") == group]
    stage_ids = {s for j in jobs for s in j.get("Stage IDs", [])}
    tasks = [e for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stage_ids]
    written = sum((t.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get(
        "Shuffle Records Written", 0) for t in tasks)
    read = [(t.get("Task Metrics") or {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            for t in tasks]
    return written, max(read) if read else 0


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    files = int(argv[1]) if len(argv) > 1 else 64
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = build_session(
        "local[8]",
        app_name="brightwash-scale-check",
        shuffle_partitions=32,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            # one scan task per file and one reduce task per shuffle partition,
            # so the per-task figures show where the hot key lands
            "spark.sql.files.maxPartitionBytes": "1m",
            "spark.sql.files.openCostInBytes": "1m",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )

    listings = testdata.listings_raw(spark, sf_dir)
    k = F.col("id")
    hot_listings = convert_types(
        listings.withColumns(
            {
                "neighbourhood": F.when(k % 3 == 0, F.lit("NATION_HOT")).otherwise(F.col("neighbourhood")),
                "price": F.when(k % 3 == 1, F.lit("$50000.50")).otherwise(F.col("price")),
            }
        ),
        LISTING_TYPES,
    )
    listings_path = scratch_dir(spark, "hot-listings")
    write_parquet(hot_listings, listings_path, files=files)

    reviews = testdata.reviews_raw(spark, sf_dir, with_order=True)
    hot = F.col("l_orderkey") % 3 == 0
    hot_reviews = reviews.select(
        F.when(hot, F.lit(1)).otherwise(F.col("listing_id")).cast("bigint").alias("listing_id"),
        F.when(hot, F.lit("1995-01-01").cast("date")).otherwise(F.col("date")).alias("date"),
        "l_orderkey",
    )
    reviews_path = scratch_dir(spark, "hot-reviews")
    write_parquet(hot_reviews, reviews_path, files=files)

    src = spark.read.parquet(listings_path)
    rev = spark.read.parquet(reviews_path)
    clean = clean_listings(src)
    runs = {
        "clean_listings (exact quantiles)": lambda: clean_listings(src).data,
        "Q1 top5_expensive": lambda: analytics.top_expensive(clean.data),
        "Q2 band_distribution": lambda: analytics.band_distribution(clean.data),
        "Q3 review_stats": lambda: analytics.review_stats(clean.data),
        "dedup_reviews": lambda: clean_reviews(rev.drop("l_orderkey")),
        "duplicate_count": lambda: dedup.duplicate_stats(rev.drop("l_orderkey")),
        "dedup_by_key": lambda: dedup.dedup_by_key(rev, ["listing_id", "date"], ["l_orderkey"]),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("done", "done")
    rows = rev.count()
    spark.stop()

    events = plan_report.read_log(log_dir)
    print(f"inputs: {files} files each; reviews {rows} rows, one row repeated in a third of them;"
          " 32 shuffle partitions, AQE coalescing off")
    print("| query | tasks | task ms max / median | shuffle records written | max records read by one task |")
    print("| --- | ---: | ---: | ---: | ---: |")
    for name in runs:
        s = plan_report.summarize(events, name)
        written, max_read = reduce_side(events, name)
        timing = f"{s['task_ms_max']} / {s['task_ms_median']:.0f}"
        print(f"| {name} | {s['tasks']} | {timing} | {written} | {max_read} |")


if __name__ == "__main__":
    main(sys.argv[1:])
