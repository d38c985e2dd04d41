"""Measure the engine's patterns against the pass-per-number style.

Usage: python scripts/compare_patterns.py [sf_dir] [cpus]

Each pair computes the same numbers two ways on the derived listings /
reviews of ``sf_dir`` and prints seconds and the number of Spark jobs:

* NULL profile: one aggregate vs one ``filter(isNull).count()`` per column
* duplicates: one grouped aggregate vs ``count() - dropDuplicates().count()``
* write: parallel write vs ``coalesce(1)``
* quantiles: exact refinement vs KLL sketches vs ``approxQuantile``
  with relative error 0.01 (values printed too)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from brightwash.operators.dedup import duplicate_stats  # noqa: E402
from brightwash.operators.profile import table_profile  # noqa: E402
from brightwash.operators.quantiles import RankSelector, sketch_quantile_row  # noqa: E402
from brightwash.plans.clean import clean_listings  # noqa: E402
from brightwash.session import build_session, scratch_dir  # noqa: E402
from brightwash.sources import testdata, write_parquet  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return round(time.perf_counter() - t, 3), out


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    cpus = int(argv[1]) if len(argv) > 1 else 8
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus)
    sc = spark.sparkContext
    tracker = sc.statusTracker()

    def jobs_of(fn):
        """Second (warm) run of ``fn``: seconds, Spark jobs, result."""
        fn()
        group = f"g{time.perf_counter_ns()}"
        sc.setJobGroup(group, group)
        sec, out = timed(fn)
        return sec, len(tracker.getJobIdsForGroup(group)), out

    # the raw tables are written once as Parquet so both styles read the same files
    listings_path = scratch_dir(spark, "cmp-listings")
    write_parquet(testdata.listings_raw(spark, sf_dir), listings_path)
    listings = spark.read.parquet(listings_path)
    reviews = testdata.reviews_raw(spark, sf_dir)
    listings.count()
    result = {}

    sec1, j1, _ = jobs_of(lambda: table_profile(listings).first())
    sec2, j2, _ = jobs_of(
        lambda: [listings.count()] + [listings.filter(F.col(c).isNull()).count() for c in listings.columns]
    )
    result["null_profile"] = {"one_aggregate": [sec1, j1], "pass_per_column": [sec2, j2]}

    sec1, j1, a = jobs_of(lambda: duplicate_stats(reviews).first().duplicates)
    sec2, j2, b = jobs_of(lambda: reviews.count() - reviews.dropDuplicates().count())
    assert a == b
    result["duplicates"] = {"grouped_aggregate": [sec1, j1], "count_minus_distinct": [sec2, j2]}

    clean = clean_listings(listings).data
    sec1, j1, _ = jobs_of(lambda: write_parquet(clean, scratch_dir(spark, "cmp-par")))
    sec2, j2, _ = jobs_of(lambda: clean.coalesce(1).write.mode("overwrite").parquet(scratch_dir(spark, "cmp-one")))
    result["write"] = {"parallel": [sec1, j1], "coalesce_1": [sec2, j2]}

    priced = clean_listings(listings).stages["priced"]
    probs = [0.01, 0.05, 0.95, 0.99]
    sec1, j1, exact = jobs_of(lambda: RankSelector(priced, "price_clean", materialize=True).quantiles(probs))
    sec2, j2, sketch = jobs_of(lambda: list(sketch_quantile_row(priced, "price_clean", probs).first()))
    sec3, j3, coarse = jobs_of(
        lambda: priced.filter(F.col("price_clean").isNotNull()).approxQuantile("price_clean", probs, 0.01)
    )
    result["quantiles"] = {
        "exact_refinement": [sec1, j1, exact],
        "sketch_4096": [sec2, j2, sketch],
        "approxQuantile_0.01": [sec3, j3, coarse],
    }
    print(json.dumps({"sf_dir": sf_dir, "cpus": cpus, "seconds_jobs": result}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
