"""The registered queries: ``(spark, sf_dir) -> DataFrame``.

Each one reads the driver's tables, derives the dirty listing-style tables
from them (see ``sources.testdata``) and runs one operator or flow over the
whole data. Column names equal those of ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwash.config import (
    DESCRIBE_COLUMNS,
    PREVIEW_COLUMNS,
    PREVIEW_ROWS,
    PRICE_PERCENTILES,
    REVIEW_STATS_K,
    REVIEW_STATS_MIN_COUNT,
    TOP_EXPENSIVE_K,
    TOP_EXPENSIVE_MIN_COUNT,
    ListingsParams,
)
from brightwash.operators import analytics, dedup, geo, price, profile, quantiles, report, states
from brightwash.operators.difference import table_differences
from brightwash.operators.fill import drop_missing
from brightwash.operators.joins import anti_join_keys
from brightwash.operators.overview import listing_overview
from brightwash.operators.trends import monthly_trend
from brightwash.operators.types import convert_types
from brightwash.plans.clean import (
    clean_listings,
    clean_neighbourhoods,
    clean_reviews,
    step_accounting,
    typed_and_filled,
)
from brightwash.plans.etl import run_etl
from brightwash.session import scratch_dir
from brightwash.streaming.reviews import review_stream, start_keyed_dedup, start_review_dedup
from brightwash.sources import testdata
from brightwash.sources.catalog import load_or_build, register_views
from brightwash.sources.files import (
    assert_verified,
    read_csv,
    table_fingerprint,
    verify_written,
    write_csv,
    write_parquet,
    write_parquet_observed,
)
from brightwash.sources.inference import apply_types, infer_types, inferred_types, type_states
from brightwash.sources.layout import write_clustered
from brightwash.sources.planning import compact, file_sizes, write_planned
from brightwash.sources.schemas import LISTINGS_CLEAN, LISTINGS_RAW
from brightwash.sources.store import Stored, TableStore

PARAMS = ListingsParams()


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.listings_raw(spark, sf_dir)


def _stages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The lazy row-filter stages (no quantile pass needed)."""
    filled = typed_and_filled(_raw(spark, sf_dir), PARAMS)
    located = drop_missing(filled, PARAMS.required)
    boxed = geo.filter_box(located, PARAMS.box)
    return {
        "filled": filled,
        "located": located,
        "boxed": boxed,
        "priced": price.add_clean_price(boxed),
    }


def _clean(spark: SparkSession, sf_dir: str):
    return clean_listings(_raw(spark, sf_dir), PARAMS)


LISTING_SOURCES = ("orders", "customer", "nation", "region")


def stored_clean_table(spark: SparkSession, sf_dir: str, store: TableStore | None = None) -> Stored:
    """The cleaned listings from the store; built and stored if the parameters
    or a source file are new."""
    sources = [testdata.table_path(sf_dir, name) for name in LISTING_SOURCES]
    store = store or TableStore(spark)
    return store.get("listings_clean", sources, lambda: _clean(spark, sf_dir).data, PARAMS, LISTINGS_CLEAN)


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned listings derived from the tables in ``sf_dir``, cleaned once
    for all questions asked of them."""
    return stored_clean_table(spark, sf_dir).data


# --- types, fills, coordinates ---------------------------------------------


def q_csv_typed_cast(spark, sf_dir):
    return convert_types(_raw(spark, sf_dir), PARAMS.types)


def q_csv_roundtrip(spark, sf_dir):
    """Raw listings written as CSV (all text), read back with the text schema
    and typed: equal to typing the source directly."""
    path = scratch_dir(spark, "listings-csv")
    raw = _raw(spark, sf_dir)
    write_csv(raw.select(*[F.col(c).cast("string") for c in raw.columns]), path, null_value=r"\N")
    back = read_csv(spark, path, schema=LISTINGS_RAW, multi_line=True, null_value=r"\N")
    return convert_types(back, PARAMS.types)


def q_csv_clean_listings(spark, sf_dir):
    """The whole listings cleaning from a CSV source (text columns, quoted
    fields, explicit schema): equal to cleaning the source directly."""
    path = scratch_dir(spark, "listings-csv-src")
    raw = _raw(spark, sf_dir)
    write_csv(raw.select(*[F.col(c).cast("string") for c in raw.columns]), path, null_value=r"\N")
    source = read_csv(spark, path, schema=LISTINGS_RAW, multi_line=True, null_value=r"\N")
    return clean_listings(source, PARAMS).data


def q_fill_constants(spark, sf_dir):
    return _stages(spark, sf_dir)["filled"].select(
        "id", "name", "host_name", "neighbourhood_group", "reviews_per_month", "minimum_nights"
    )


def q_null_group_rows(spark, sf_dir):
    """Neighbourhood rows (as seen in the listings) whose group is missing."""
    raw = testdata.neighbourhoods_seen(spark, sf_dir)
    return raw.filter(F.col("neighbourhood_group").isNull())


def q_fill_dimension(spark, sf_dir):
    """The dimension fill on the neighbourhoods seen in the listings."""
    return clean_neighbourhoods(testdata.neighbourhoods_seen(spark, sf_dir))


def q_drop_missing_coords(spark, sf_dir):
    return _stages(spark, sf_dir)["located"].select("id", "latitude", "longitude")


def q_geo_stats(spark, sf_dir):
    stats = geo.geo_profile(_stages(spark, sf_dir)["located"], PARAMS.box)
    rounded = {
        c: F.round(c, 6)
        for c in ("lat_mean", "lat_stddev", "lon_mean", "lon_stddev")
    }
    rounded["pct_out_of_range"] = F.round("pct_out_of_range", 4)
    return stats.withColumns(rounded)


def q_geo_outside_sample(spark, sf_dir):
    return geo.outside_sample(_stages(spark, sf_dir)["located"], PARAMS.box, n=10)


def q_geo_inside(spark, sf_dir):
    return _stages(spark, sf_dir)["boxed"].select("id", "latitude", "longitude")


# --- price -------------------------------------------------------------------


def q_price_clean(spark, sf_dir):
    return _stages(spark, sf_dir)["priced"].select("id", "price", "price_clean")


def q_price_nulls(spark, sf_dir):
    return price.price_text_profile(_stages(spark, sf_dir)["priced"])


def q_price_percentiles(spark, sf_dir):
    return quantiles.quantile_table(
        _stages(spark, sf_dir)["priced"],
        "price_clean",
        list(PRICE_PERCENTILES),
        ["p1", "p5", "p95", "p99"],
        method="exact",
        materialize=True,
    )


def q_bigint_percentiles(spark, sf_dir):
    """Exact percentiles of 64-bit keys that doubles cannot tell apart."""
    return quantiles.quantile_table(
        testdata.line_keys(spark, sf_dir), "line_key", list(PRICE_PERCENTILES), ["p1", "p5", "p95", "p99"], materialize=True
    )


def q_price_trim(spark, sf_dir):
    return _clean(spark, sf_dir).stages["trimmed"].select("id", "price_clean")


def q_price_median_fill(spark, sf_dir):
    return _clean(spark, sf_dir).data.select("id", "price")


def q_clean_listings_full(spark, sf_dir):
    return _clean(spark, sf_dir).data


def q_step_accounting(spark, sf_dir):
    cleaned = _clean(spark, sf_dir)
    return step_accounting(
        _raw(spark, sf_dir), cleaned.percentiles[0.01], cleaned.percentiles[0.99], PARAMS
    )


# --- reviews -----------------------------------------------------------------


def q_dedup_reviews(spark, sf_dir):
    return clean_reviews(testdata.reviews_raw(spark, sf_dir))


def q_duplicate_count(spark, sf_dir):
    return dedup.duplicate_stats(testdata.reviews_raw(spark, sf_dir))


def q_dedup_by_key(spark, sf_dir):
    reviews = testdata.reviews_raw(spark, sf_dir, with_order=True)
    return dedup.dedup_by_key(reviews, ["listing_id", "date"], ["l_orderkey"])


def q_duplicates_before_after(spark, sf_dir):
    raw = testdata.reviews_raw(spark, sf_dir)
    before = dedup.duplicate_stats(raw).select(F.lit("raw").alias("stage"), "*")
    clean = dedup.dealt_by_row(clean_reviews(raw), raw.count())
    after = dedup.duplicate_stats(clean).select(F.lit("clean").alias("stage"), "*")
    return before.unionByName(after)


def _deduplicated_stream(spark, sf_dir, start) -> DataFrame:
    """Reviews arriving as two waves of files (even and odd orders, which
    share duplicate rows), deduplicated by a stream that is run after each
    wave and takes up where it stopped; the sink equals the batch dedup."""
    source = scratch_dir(spark, "review-feed")
    sink = scratch_dir(spark, "review-sink")
    ckpt = scratch_dir(spark, "review-stream-ckpt")
    reviews = testdata.reviews_raw(spark, sf_dir, with_order=True)
    for parity in (0, 1):
        wave = reviews.filter(F.col("l_orderkey") % 2 == parity).drop("l_orderkey")
        wave.write.mode("append").parquet(source)
        query = start(review_stream(spark, source), sink, ckpt)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return spark.read.parquet(sink)


def q_stream_dedup_reviews(spark, sf_dir):
    """With the rows seen so far in the state store."""
    return _deduplicated_stream(spark, sf_dir, start_keyed_dedup)


def q_stream_dedup_stored(spark, sf_dir):
    """With the stored table as the state."""
    return _deduplicated_stream(spark, sf_dir, start_review_dedup)


def q_reviews_per_month(spark, sf_dir):
    return analytics.monthly_counts(clean_reviews(testdata.reviews_raw(spark, sf_dir)))


# --- profiling ---------------------------------------------------------------


def q_null_profile(spark, sf_dir):
    return profile.null_profile(_raw(spark, sf_dir))


def _raw_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "listings": _raw(spark, sf_dir),
        "neighbourhoods": testdata.neighbourhoods_raw(spark, sf_dir),
        "reviews": testdata.reviews_raw(spark, sf_dir),
    }


def q_raw_null_profiles(spark, sf_dir):
    """NULL count of every column of the three raw tables."""
    parts = [
        profile.null_profile(df).select(F.lit(name).alias("dataset"), "*")
        for name, df in _raw_tables(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_raw_duplicates(spark, sf_dir):
    """Full-row duplicates of the three raw tables (one shuffle each)."""
    parts = [
        dedup.duplicate_stats(df).select(F.lit(name).alias("dataset"), "*")
        for name, df in _raw_tables(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_row_counts(spark, sf_dir):
    return profile.row_counts(
        {
            "listings": _raw(spark, sf_dir),
            "neighbourhoods": testdata.neighbourhoods_raw(spark, sf_dir),
            "reviews": testdata.reviews_raw(spark, sf_dir),
        }
    )


def q_describe_numeric(spark, sf_dir):
    return profile.describe_numeric(clean_table(spark, sf_dir), list(DESCRIBE_COLUMNS), digits=6)


def q_distinct_price(spark, sf_dir):
    return profile.distinct_values(_stages(spark, sf_dir)["boxed"], "price")


def q_column_preview(spark, sf_dir):
    return profile.preview(clean_table(spark, sf_dir), list(PREVIEW_COLUMNS), PREVIEW_ROWS, ["id"])


# --- analytics on the clean table --------------------------------------------


def q_group_count(spark, sf_dir):
    return analytics.group_count(clean_table(spark, sf_dir), "room_type")


def q_top10_groups(spark, sf_dir):
    return analytics.top_groups(clean_table(spark, sf_dir), "neighbourhood", 10)


def q_price_by_group(spark, sf_dir):
    return analytics.value_by_group(clean_table(spark, sf_dir), "room_type")


def q_price_overall(spark, sf_dir):
    return analytics.value_overall(clean_table(spark, sf_dir))


def _with_views(spark, sf_dir) -> None:
    register_views(
        {
            "listings": clean_table(spark, sf_dir),
            "neighbourhoods": clean_neighbourhoods(testdata.neighbourhoods_raw(spark, sf_dir)),
            "reviews": clean_reviews(testdata.reviews_raw(spark, sf_dir)),
        }
    )


def q_top5_expensive(spark, sf_dir):
    _with_views(spark, sf_dir)
    return analytics.top_expensive_sql(spark, TOP_EXPENSIVE_MIN_COUNT, TOP_EXPENSIVE_K)


def q_band_distribution(spark, sf_dir):
    _with_views(spark, sf_dir)
    return analytics.band_distribution_sql(spark)


def q_review_stats(spark, sf_dir):
    _with_views(spark, sf_dir)
    return analytics.review_stats_sql(spark, REVIEW_STATS_MIN_COUNT, REVIEW_STATS_K)


# --- report, integrity, storage ----------------------------------------------


def q_reduction_table(spark, sf_dir):
    raw_reviews = testdata.reviews_raw(spark, sf_dir)
    raw_neighb = testdata.neighbourhoods_raw(spark, sf_dir)
    return report.reduction_table(
        [
            ("listings", _raw(spark, sf_dir), clean_table(spark, sf_dir)),
            ("neighbourhoods", raw_neighb, clean_neighbourhoods(raw_neighb)),
            ("reviews", raw_reviews, clean_reviews(raw_reviews)),
        ]
    )


def q_top_nulls(spark, sf_dir):
    return report.top_nulls(_raw(spark, sf_dir), clean_table(spark, sf_dir))


def q_ref_integrity(spark, sf_dir):
    """Listings whose neighbourhood is missing from the dimension or NULL."""
    return analytics.orphans(clean_table(spark, sf_dir), testdata.neighbourhoods_raw(spark, sf_dir))


def q_parquet_roundtrip(spark, sf_dir):
    """Clean table written as Snappy Parquet, verified, read back."""
    final = clean_table(spark, sf_dir)
    path = scratch_dir(spark, "listings-clean")
    written = write_parquet_observed(final, path)
    assert_verified(verify_written(spark, path, written, final.schema))
    return spark.read.parquet(path)


def q_load_or_build(spark, sf_dir):
    """First call builds the clean table (nothing live or stored yet) and
    stores it; the second finds the stored table; the third the live view of it."""
    path = scratch_dir(spark, "listings-stored")
    view = "stored_" + path.rsplit("-", 1)[-1]
    build = lambda: _clean(spark, sf_dir).data
    write_parquet(load_or_build(spark, path, build, view), path)
    register_views({view: load_or_build(spark, path, build, view)})
    return load_or_build(spark, None, build, view)


def _etl(spark, sf_dir):
    return run_etl(
        spark,
        _raw(spark, sf_dir),
        testdata.neighbourhoods_raw(spark, sf_dir),
        testdata.reviews_raw(spark, sf_dir),
        scratch_dir(spark, "etl"),
    )


def q_etl_verification(spark, sf_dir):
    """The whole cleaning run (three tables written and read back); the
    verification row of each written table."""
    return _etl(spark, sf_dir).verification


def q_etl_observed_accounting(spark, sf_dir):
    """Step accounting of the whole run, observed while writing."""
    return _etl(spark, sf_dir).accounting


def q_partitioned_read(spark, sf_dir):
    """Clean table written partitioned by room type; a filter on the
    partition column reads one folder only."""
    final = clean_table(spark, sf_dir)
    path = scratch_dir(spark, "listings-by-room")
    write_parquet(final, path, partition_by=("room_type",))
    back = spark.read.parquet(path).filter(F.col("room_type") == "1-URGENT")
    return back.select(*final.columns)


# --- store, inference, layout, differences, states -----------------------------


def q_store_reuse(spark, sf_dir):
    """Reviews from a date on, asked of an empty store: built, found again,
    built for another date, found again."""
    store = TableStore(spark, scratch_dir(spark, "store"))
    source = [testdata.table_path(sf_dir, "lineitem")]
    parts = []
    for step, since in enumerate(("1990-01-01", "1990-01-01", "1996-01-01", "1996-01-01"), 1):
        build = lambda: clean_reviews(testdata.reviews_raw(spark, sf_dir)).filter(F.col("date") >= since)  # noqa: B023, E731
        found = store.get("reviews", source, build, since)
        parts.append(found.data.agg(F.lit(step).alias("step"), F.lit(found.hit).alias("hit"), F.count(F.lit(1)).alias("rows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _csv_text(spark, sf_dir) -> DataFrame:
    """The listings CSV with malformed records, read as text columns."""
    path = scratch_dir(spark, "listings-text")
    testdata.listings_csv_lines(spark, sf_dir).write.text(path)
    return read_csv(spark, path, LISTINGS_RAW, True, r"\N", "corrupt_record", header=False)


INFERENCE_TOLERANCE = 0.05


def q_csv_inferred_types(spark, sf_dir):
    """Type of each text column of a CSV, values that do not fit it, and rows
    that do not fit the schema, in one pass."""
    return infer_types(type_states(_csv_text(spark, sf_dir), "corrupt_record"), INFERENCE_TOLERANCE)


def q_csv_quarantine(spark, sf_dir):
    """Every value and row of that CSV that the inferred types leave aside."""
    text = _csv_text(spark, sf_dir)
    types = inferred_types(type_states(text, "corrupt_record"), INFERENCE_TOLERANCE)
    found = apply_types(text, types, "corrupt_record", carry=("id",)).quarantine
    return found.select(
        F.col("id").cast("bigint").alias("id"),
        F.coalesce("column", F.lit("*")).alias("column_name"),
        F.when(F.col("column").isNotNull(), F.col("value")).alias("value"),
    )


def q_csv_inferred_table(spark, sf_dir):
    """The rows of that CSV that fit, typed."""
    text = _csv_text(spark, sf_dir)
    types = inferred_types(type_states(text, "corrupt_record"), INFERENCE_TOLERANCE)
    return apply_types(text, types, "corrupt_record").typed


def q_clustered_box_read(spark, sf_dir):
    """Located listings stored along a space-filling curve; a small box read back."""
    path = scratch_dir(spark, "listings-clustered")
    located = _stages(spark, sf_dir)["located"].select("id", "latitude", "longitude", "room_type")
    write_clustered(located, path, ["latitude", "longitude"])
    inside = F.col("latitude").between(-33.55, -33.45) & F.col("longitude").between(-70.6, -70.4)
    return spark.read.schema(located.schema).parquet(path).filter(inside)


def q_table_differences(spark, sf_dir):
    before, after = testdata.orders_changed(spark, sf_dir)
    return table_differences(before, after, "o_orderkey", leaf_rows=500)


def _profiled_in_waves(spark, sf_dir) -> states.Refreshed:
    """Raw listings arriving in two waves of files; the second refresh of the
    states reads the second wave only."""
    path, root = scratch_dir(spark, "listings-waves"), scratch_dir(spark, "listings-states")
    raw = _raw(spark, sf_dir)
    for parity in (0, 1):
        raw.filter(F.col("id") % 2 == parity).write.mode("append").parquet(path)
        refreshed = states.refresh_states(spark, path, root, raw.schema)
    return refreshed


def q_incremental_profile(spark, sf_dir):
    profiled = states.table_profile(_profiled_in_waves(spark, sf_dir).states)
    return profiled.drop("median", "distinct_values")


def q_top_nulls_from_states(spark, sf_dir):
    return states.top_null_columns(_profiled_in_waves(spark, sf_dir).states)


def q_listing_overview(spark, sf_dir):
    """All grouped analyses of the clean listings, from one scan of them."""
    return listing_overview(clean_table(spark, sf_dir))


def q_host_trends(spark, sf_dir):
    """Last reviews per host and month, months without any filled in."""
    return monthly_trend(_raw(spark, sf_dir), "host_id", "last_review")


def q_orphans_large_dimension(spark, sf_dir):
    """Customers without an open order: the dimension is the larger table."""
    customers = testdata.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    open_orders = testdata.table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("custkey"))
    return anti_join_keys(customers, open_orders, "custkey")


# the file counts of the stored tables that are matched
STORED_FILES = {"listings": 1, "neighbourhoods": 1, "reviews": 4}


def q_file_counts(spark, sf_dir):
    """The three raw tables stored in an exact number of files."""
    parts = []
    for name, df in _raw_tables(spark, sf_dir).items():
        path = scratch_dir(spark, f"{name}-files")
        write_parquet(df, path, files=STORED_FILES[name])
        files = file_sizes(spark, path).agg(F.count(F.lit(1)).alias("files")).scalar()
        parts.append(spark.read.schema(df.schema).parquet(path).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows")).withColumn("files", files))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_planned_files(spark, sf_dir):
    """Line items stored in the files that 20,000 rows each ask for."""
    lines = testdata.table(spark, sf_dir, "lineitem")
    path = scratch_dir(spark, "planned")
    files = write_planned(lines, path, rows_per_file=20_000)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.lit(files).cast("bigint").alias("planned"),
        F.count(F.lit(1)).alias("files"),
        F.sum("n").alias("rows"),
        (F.max("n") <= F.min("n") * 1.1 + 10).alias("even"),
    )


def q_compacted_files(spark, sf_dir):
    """Reviews stored in many small files, merged: fewer files, the same rows."""
    many, few = scratch_dir(spark, "many-files"), scratch_dir(spark, "few-files")
    reviews = testdata.reviews_raw(spark, sf_dir)
    write_parquet(reviews, many, files=24)
    files = compact(spark, many, few)
    before, after = (table_fingerprint(spark.read.schema(reviews.schema).parquet(p)) for p in (many, few))
    same = F.lit(before.first()["checksum"]) == F.col("checksum")
    return after.select("rows", same.alias("same_rows"), F.lit(1 <= files < 24).alias("fewer_files"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
