"""The whole batch flow: clean three tables, store them, verify, report.

``run_etl`` is the cleaning run (raw -> clean Parquet, verified); its
``EtlRun.observed_report`` gives the quality summary from counts observed
during the run, without another pass. ``report_tables`` computes the same
summary (plus price and room-type figures) from any raw / clean tables.
All results are DataFrames; nothing row-level is collected.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brightwash.config import TOP_NULLS_K, ListingsParams
from brightwash.operators import analytics, dedup, report
from brightwash.plans.clean import (
    CleanListings,
    clean_listings,
    clean_neighbourhoods,
    step_accounting,
)
from brightwash.sources.catalog import register_views, table_exists
from brightwash.sources.files import assert_verified, verify_written, write_parquet_observed


@dataclass
class EtlRun:
    """Where the clean tables went and what was checked on the way."""

    paths: dict[str, str]
    verification: DataFrame | None
    accounting: DataFrame
    listings: CleanListings
    written: dict[str, dict] = field(default_factory=dict)
    # name -> {"rows": n, "nulls": {column: n}} before and after cleaning
    raw_profile: dict[str, dict] = field(default_factory=dict)
    clean_profile: dict[str, dict] = field(default_factory=dict)

    def observed_report(self, spark: SparkSession, top_k: int = TOP_NULLS_K) -> dict[str, DataFrame]:
        """Reduction table, top NULL columns and review duplicates from the
        counts observed during the run: no pass over any table.

        Full-row dedup removes exactly the duplicates, so the raw duplicate
        count is raw rows minus rows written.
        """
        reduction = []
        for name in ("listings", "neighbourhoods", "reviews"):
            initial = self.raw_profile[name]["rows"]
            final = self.clean_profile[name]["rows"]
            reduction.append((name, initial, final))
        raw_nulls = self.raw_profile["listings"]["nulls"]
        final_nulls = self.clean_profile["listings"]["nulls"]
        ranked = sorted(raw_nulls.items(), key=lambda kv: (-kv[1], kv[0]))[:top_k]
        top = [(c, n, final_nulls.get(c, 0)) for c, n in ranked]
        raw_rev, clean_rev = self.raw_profile["reviews"]["rows"], self.clean_profile["reviews"]["rows"]
        dups = [("raw", raw_rev, clean_rev, raw_rev - clean_rev), ("clean", clean_rev, clean_rev, 0)]
        return {
            "reduction": spark.createDataFrame(
                reduction, "dataset string, initial long, final long"
            ).withColumn("pct_reduction", report.pct_reduction(F.col("initial"), F.col("final"))),
            "top_nulls": spark.createDataFrame(
                top, "column_name string, nulls_raw long, nulls_final long"
            ),
            "duplicates": spark.createDataFrame(
                dups, "stage string, rows long, distinct_rows long, duplicates long"
            ),
        }


def _null_metrics(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]


def _profile(columns: list[str], metrics: dict) -> dict:
    return {
        "rows": int(metrics["rows"]),
        "nulls": {c: int(metrics[f"nulls_{i}"]) for i, c in enumerate(columns)},
    }


def run_etl(
    spark: SparkSession,
    listings_raw: DataFrame,
    neighbourhoods_raw: DataFrame,
    reviews_raw: DataFrame,
    out_dir: str,
    params: ListingsParams = ListingsParams(),
    files: dict[str, int] | None = None,
    materialize: bool = True,
    verify: str | None = "checksum",
    parallel: bool = True,
) -> EtlRun:
    """Clean, write Snappy Parquet, verify each written table.

    ``files`` optionally fixes the file count per table (``repartition``,
    never ``coalesce(1)``). Verification compares the read-back table with
    the row count and checksum observed while writing; the step accounting
    of the listings is observed the same way, without a pass of its own.
    ``verify``: ``"checksum"`` re-reads and hashes every written table,
    ``"count"`` checks schema and row count only (no column data read),
    ``None`` skips the read-back. ``parallel`` submits the three tables'
    jobs from separate threads.
    """
    files = files or {}
    observe = params.quantile_method == "exact" and materialize
    # Counters sit in the result stage of each write (after any shuffle):
    # there Spark applies each task's update once, even when tasks or map
    # stages are re-run after an executor loss.
    raw_obs = {
        name: Observation(f"raw-{name}-{uuid.uuid4().hex[:8]}") for name in ("neighbourhoods", "reviews")
    }
    holder: dict[str, CleanListings] = {}

    def listings_table() -> DataFrame:
        holder["listings"] = clean_listings(listings_raw, params, materialize=materialize, observe=observe)
        return holder["listings"].data

    def neighbourhoods_table() -> DataFrame:
        observed = neighbourhoods_raw.observe(
            raw_obs["neighbourhoods"], F.count(F.lit(1)).alias("rows"), *_null_metrics(neighbourhoods_raw)
        )
        return clean_neighbourhoods(observed)

    def reviews_table() -> DataFrame:
        # Full-row dedup that keeps the number of copies, so the raw counts
        # are sums over the (post-shuffle) groups.
        copies = F.col("_copies")
        return dedup.dedup_with_copies(reviews_raw, "_copies").observe(
            raw_obs["reviews"],
            F.coalesce(F.sum(copies), F.lit(0)).alias("rows"),
            *[
                F.coalesce(F.sum(F.when(F.col(c).isNull(), copies)), F.lit(0)).alias(f"nulls_{i}")
                for i, c in enumerate(reviews_raw.columns)
            ],
        ).drop("_copies")

    def store(name: str, build) -> tuple:
        df = build()
        path = os.path.join(out_dir, f"{name}_clean.parquet")
        metrics = write_parquet_observed(df, path, files=files.get(name), extra=_null_metrics(df))
        check = None
        if verify:
            check = verify_written(spark, path, metrics, df.schema, content=verify == "checksum")
            assert_verified(check)
            check = check.select(F.lit(name).alias("dataset"), "*")
        return df, path, metrics, check

    builders = {
        "listings": listings_table,
        "neighbourhoods": neighbourhoods_table,
        "reviews": reviews_table,
    }
    # The three tables are independent: their jobs are submitted from
    # separate threads, so the scheduler can fill the cluster with one
    # table's tasks while another waits on a small stage (e.g. a quantile pass).
    with ThreadPoolExecutor(max_workers=len(builders) if parallel else 1) as pool:
        futures = {name: pool.submit(store, name, build) for name, build in builders.items()}
        results = {name: future.result() for name, future in futures.items()}
    listings = holder["listings"]
    clean = {name: r[0] for name, r in results.items()}
    paths = {name: r[1] for name, r in results.items()}
    written = {name: r[2] for name, r in results.items()}
    verification = None
    for name in builders:
        check = results[name][3]
        if check is not None:
            verification = check if verification is None else verification.unionByName(check)
    if observe:
        # counted while the price column and the clean table were written
        accounting = listings.observed_accounting(spark, written["listings"]["rows"])
    else:
        accounting = step_accounting(
            listings_raw, listings.percentiles[params.trim[0]], listings.percentiles[params.trim[1]], params
        )
    clean_profile = {name: _profile(clean[name].columns, written[name]) for name in clean}
    raw_profile = {
        "neighbourhoods": _profile(neighbourhoods_raw.columns, raw_obs["neighbourhoods"].get),
        "reviews": _profile(reviews_raw.columns, raw_obs["reviews"].get),
    }
    if observe:
        raw_profile["listings"] = _profile(listings_raw.columns, listings.observations["raw"].get)
    else:
        counted = listings_raw.agg(F.count(F.lit(1)).alias("rows"), *_null_metrics(listings_raw)).first()
        raw_profile["listings"] = _profile(listings_raw.columns, counted.asDict())
    return EtlRun(paths, verification, accounting, listings, written, raw_profile, clean_profile)


def load_clean(spark: SparkSession, paths: dict[str, str], register: bool = True) -> dict[str, DataFrame]:
    """Read the stored clean tables (and expose them as SQL views)."""
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    if register:
        register_views(tables)
    return tables


def report_tables(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    clean: dict[str, DataFrame],
) -> dict[str, DataFrame]:
    """Quality and headline metrics as DataFrames.

    ``raw`` and ``clean`` map ``listings``, ``neighbourhoods`` and
    ``reviews`` to their tables. The top-5 query runs as SQL when a
    ``listings`` view is registered, otherwise on the DataFrame.
    """
    listings = clean["listings"]
    top5 = (
        analytics.top_expensive_sql(spark)
        if table_exists(spark, "listings")
        else analytics.top_expensive(listings)
    )
    dup_before = dedup.duplicate_stats(raw["reviews"]).select(F.lit("raw").alias("stage"), "*")
    dup_after = dedup.duplicate_stats(clean["reviews"]).select(F.lit("clean").alias("stage"), "*")
    return {
        "reduction": report.reduction_table(
            [(name, raw[name], clean[name]) for name in ("listings", "neighbourhoods", "reviews")]
        ),
        "top_nulls": report.top_nulls(raw["listings"], listings),
        "duplicates": dup_before.unionByName(dup_after),
        "price": analytics.value_overall(listings),
        "room_types": analytics.group_count(listings, "room_type"),
        "top_expensive": top5,
    }
