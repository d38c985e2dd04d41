"""Run the whole cleaning flow on raw tables and print its reports.

Usage (local or through spark-submit on a cluster):

    python scripts/run_etl.py --listings L --neighbourhoods N --reviews R --out OUT
        [--format csv|parquet] [--files listings=1,reviews=4] [--verify checksum|count|none]

CSV inputs are read with the explicit schemas of ``sources.schemas`` (header,
RFC 4180 quoting, multi-line records allowed for listings). The clean tables
are written as Snappy Parquet under OUT and verified; then the step
accounting, the quality report and the three SQL analyses are shown (all
small aggregate results).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brightwash.operators import analytics  # noqa: E402
from brightwash.plans.etl import load_clean, run_etl  # noqa: E402
from brightwash.session import build_session  # noqa: E402
from brightwash.sources import read_csv  # noqa: E402
from brightwash.sources.schemas import LISTINGS_RAW, NEIGHBOURHOODS, REVIEWS  # noqa: E402


def parse_files(text: str | None) -> dict[str, int]:
    if not text:
        return {}
    pairs = (item.split("=", 1) for item in text.split(",") if item)
    return {name: int(count) for name, count in pairs}


def main(argv: list[str], spark=None) -> None:
    """Run the flow; an existing ``spark`` session is used and left running."""
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--listings", required=True)
    ap.add_argument("--neighbourhoods", required=True)
    ap.add_argument("--reviews", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--files", help="exact file counts, e.g. listings=1,reviews=4")
    ap.add_argument("--verify", choices=["checksum", "count", "none"], default="checksum")
    ap.add_argument("--scratch", help="folder that all executors share, unless spark.checkpoint.dir is set")
    ap.add_argument("--master", help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    owned = spark is None
    extra = {"spark.checkpoint.dir": args.scratch} if args.scratch else {}
    spark = spark or build_session(args.master, app_name="brightwash-etl", extra=extra)
    if args.format == "csv":
        listings = read_csv(spark, args.listings, schema=LISTINGS_RAW, multi_line=True)
        neighbourhoods = read_csv(spark, args.neighbourhoods, schema=NEIGHBOURHOODS)
        reviews = read_csv(spark, args.reviews, schema=REVIEWS)
    else:
        listings = spark.read.parquet(args.listings)
        neighbourhoods = spark.read.parquet(args.neighbourhoods)
        reviews = spark.read.parquet(args.reviews)

    run = run_etl(
        spark,
        listings,
        neighbourhoods,
        reviews,
        args.out,
        files=parse_files(args.files),
        verify=None if args.verify == "none" else args.verify,
    )
    if run.verification is not None:
        run.verification.show(truncate=False)
    run.accounting.show(truncate=False)
    for name, df in run.observed_report(spark).items():
        print(name)
        df.show(truncate=False)
    load_clean(spark, run.paths)  # registers the views used by the SQL analyses
    analytics.top_expensive_sql(spark).show(truncate=False)
    analytics.band_distribution_sql(spark).show(50, truncate=False)
    analytics.review_stats_sql(spark).show(truncate=False)
    if owned:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
