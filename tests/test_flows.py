"""Composite flows on the derived tables: invariants and the entry point."""

import pytest
from pyspark.sql import functions as F

from brightwash.config import Box, ListingsParams
from brightwash.plans.clean import clean_listings, clean_reviews, step_accounting, typed_and_filled
from brightwash.plans.etl import load_clean, report_tables, run_etl
from brightwash.session import scratch_dir
from brightwash.sources import testdata
from conftest import SF001, SF01


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = testdata.listings_raw(spark, SF01)
    return raw, clean_listings(raw)


def test_fixture_numbers(spark, cleaned):
    raw, c = cleaned
    assert raw.count() == 15000
    assert c.stages["boxed"].count() == 8560
    assert c.data.count() == 8420
    values = spark.range(1).select(
        c.percentiles[0.01].alias("p1"), c.percentiles[0.99].alias("p99"), c.median.alias("m")
    ).first()
    assert (values.p1, values.p99, values.m) == (503.5, 164882.5, 83084.5)


def test_invariants(spark, cleaned):
    raw, c = cleaned
    final = c.data
    box = Box()
    # required columns and filled columns have no NULLs, every row is in the box
    nulls = final.agg(
        *[F.count_if(F.col(x).isNull()).alias(x) for x in
          ("latitude", "longitude", "price", "name", "host_name", "neighbourhood_group",
           "minimum_nights", "reviews_per_month")]
    ).first()
    assert all(v == 0 for v in nulls)
    assert final.filter(~(F.col("latitude").between(box.min_lat, box.max_lat)
                          & F.col("longitude").between(box.min_lon, box.max_lon))).count() == 0
    # group counts add up to the total
    total = final.count()
    assert final.groupBy("room_type").count().agg(F.sum("count")).first()[0] == total
    # price column is last and typed
    assert final.columns[-1] == "price" and dict(final.dtypes)["price"] == "double"
    assert dict(final.dtypes)["id"] == "bigint" and dict(final.dtypes)["minimum_nights"] == "int"


def test_mean_after_fill_identity(spark, cleaned):
    _, c = cleaned
    trimmed = c.stages["trimmed"]
    parts = trimmed.agg(
        F.sum("price_clean").alias("s"), F.count("price_clean").alias("k"), F.count(F.lit(1)).alias("n")
    ).first()
    median = spark.range(1).select(c.median.alias("m")).first().m
    mean = c.data.agg(F.avg("price")).first()[0]
    assert mean == pytest.approx((parts.s + (parts.n - parts.k) * median) / parts.n, rel=1e-12)


def test_step_accounting_consistent(spark, cleaned):
    raw, c = cleaned
    acc = {r.step: r for r in step_accounting(raw, c.percentiles[0.01], c.percentiles[0.99]).collect()}
    assert acc["drop_missing_coords"].rows_in == 15000
    assert acc["geo_box"].rows_out == c.stages["boxed"].count()
    assert acc["price_trim"].rows_out == c.data.count()
    for r in acc.values():
        assert r.rows_in - r.rows_out == r.removed
    assert acc["price_median_fill"].values_filled == c.stages["trimmed"].filter(
        F.col("price_clean").isNull()).count()


def test_sketch_method_runs_lazily_and_agrees_on_small_data(spark):
    raw = testdata.listings_raw(spark, SF001)
    exact = clean_listings(raw)
    approx = clean_listings(raw, ListingsParams(quantile_method="sketch"))
    a = sorted(exact.data.select("id", "price").collect())
    b = sorted(approx.data.select("id", "price").collect())
    assert a == b


def test_reviews_dedup_leaves_no_duplicates(spark):
    raw = testdata.reviews_raw(spark, SF001)
    clean = clean_reviews(raw)
    assert clean.count() == clean.dropDuplicates().count() == raw.count() - 36


def test_etl_run_writes_verifies_and_reports(spark):
    raw = {
        "listings": testdata.listings_raw(spark, SF001),
        "neighbourhoods": testdata.neighbourhoods_raw(spark, SF001),
        "reviews": testdata.reviews_raw(spark, SF001),
    }
    run = run_etl(spark, raw["listings"], raw["neighbourhoods"], raw["reviews"], scratch_dir(spark, "etl-test"))
    checks = {r.dataset: r for r in run.verification.collect()}
    assert all(r.content_ok and r.schema_ok for r in checks.values())
    assert checks["listings"].rows_read == 369
    clean = load_clean(spark, run.paths)
    reports = report_tables(spark, raw, clean)
    red = {r.dataset: r for r in reports["reduction"].collect()}
    assert red["listings"].initial == 1500 and red["listings"].final == 369
    dups = {r.stage: r.duplicates for r in reports["duplicates"].collect()}
    assert dups == {"raw": 36, "clean": 0}
    assert reports["top_expensive"].count() == 0  # no neighbourhood has 50 listings at sf0.001
    # the observed report equals the one computed from the tables
    observed = run.observed_report(spark)
    for key in ("reduction", "top_nulls", "duplicates"):
        assert sorted(observed[key].collect()) == sorted(reports[key].collect()), key
    # the observed accounting equals the one-pass aggregate
    c = run.listings
    direct = step_accounting(raw["listings"], c.percentiles[0.01], c.percentiles[0.99])
    assert sorted(run.accounting.collect()) == sorted(direct.collect())


def test_entry_returns_rows(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert len(rows) == 5
    assert rows[0].precio_promedio >= rows[-1].precio_promedio


def test_published_mean_is_consistent_with_median_fill():
    """The published run: 12,983 prices with mean 85,521.71354848648 and
    1,977 NULL prices filled with the median 43,470 give the published
    overall mean 79,964.47840909091 over 14,960 rows (fill after trim)."""
    overall = (12983 * 85521.71354848648 + 1977 * 43470) / 14960
    assert overall == pytest.approx(79964.47840909091, rel=1e-12)


def _raw_like(spark, rows):
    from brightwash.sources.schemas import LISTINGS_RAW

    return spark.createDataFrame(rows, LISTINGS_RAW)


def _row(i, price, lat="-33.5", lon="-70.5"):
    values = {c: None for c in
              ("name", "host_id", "host_name", "neighbourhood_group", "room_type", "minimum_nights",
               "number_of_reviews", "last_review", "reviews_per_month", "calculated_host_listings_count",
               "availability_365", "number_of_reviews_ltm", "license")}
    values.update(id=str(i), neighbourhood="N", latitude=lat, longitude=lon, price=price)
    from brightwash.sources.schemas import LISTING_COLUMNS

    return tuple(values[c] for c in LISTING_COLUMNS)


@pytest.mark.parametrize("method", ["exact", "sketch"])
def test_empty_input_does_not_fail(spark, method):
    raw = _raw_like(spark, [])
    c = clean_listings(raw, ListingsParams(quantile_method=method))
    assert c.data.count() == 0
    acc = step_accounting(raw, c.percentiles[0.01], c.percentiles[0.99]).collect()
    assert all(r.rows_in == 0 and r.removed == 0 for r in acc)


def test_all_prices_missing_keeps_rows_with_null_fill(spark):
    raw = _raw_like(spark, [_row(i, p) for i, p in enumerate([None, "", "NULL", "n/a"])] + [_row(9, "$5", lat="-40")])
    c = clean_listings(raw)
    rows = c.data.collect()
    assert len(rows) == 4 and all(r.price is None for r in rows)


def test_observed_run_on_empty_tables(spark):
    raw = _raw_like(spark, [])
    empty_n = spark.createDataFrame([], "neighbourhood_group string, neighbourhood string")
    empty_r = spark.createDataFrame([], "listing_id long, date date")
    run = run_etl(spark, raw, empty_n, empty_r, scratch_dir(spark, "etl-empty"))
    assert [r.rows_in for r in run.accounting.collect()] == [0, 0, 0, 0]
    red = {r.dataset: r.pct_reduction for r in run.observed_report(spark)["reduction"].collect()}
    assert red == {"listings": 0.0, "neighbourhoods": 0.0, "reviews": 0.0}


def test_one_rounding_rule(spark):
    """32 to 31 rows are 3.125 %: the observed and the direct table agree."""
    from brightwash.operators.report import pct_reduction, reduction_table

    direct = reduction_table([("t", spark.range(32), spark.range(31))]).first().pct_reduction
    row = spark.createDataFrame([(32, 31)], "a long, b long")
    assert direct == row.select(pct_reduction(F.col("a"), F.col("b")).alias("p")).first().p == 3.13


def test_ranked_results_come_in_order(cleaned):
    from brightwash.operators import analytics

    data = cleaned[1].data
    counts = analytics.group_count(data, "room_type").collect()
    assert [r["count"] for r in counts] == sorted((r["count"] for r in counts), reverse=True)
    assert any(r.room_type is None for r in counts)
    bands = [(r.room_type or "", -r.cantidad, r.rango_precio) for r in analytics.band_distribution(data).collect()]
    assert bands == sorted(bands) and bands[0][0] == ""
    means = [r.precio_promedio for r in analytics.value_by_group(data, "room_type").collect()]
    assert means == sorted(means, reverse=True)


def test_row_level_steps_are_idempotent(spark):
    """Types, fills, required coordinates and the box give the same rows when
    applied again. (The percentile trim is not idempotent by definition: run
    again, it removes the new outer 1 % on each side.)"""
    from brightwash.operators.fill import drop_missing
    from brightwash.operators.geo import filter_box

    params = ListingsParams()

    def steps(df):
        return filter_box(drop_missing(typed_and_filled(df, params), params.required), params.box)

    once = steps(testdata.listings_raw(spark, SF001))
    twice = steps(once)
    assert once.schema == twice.schema
    assert sorted(once.collect()) == sorted(twice.collect())


def test_approx_route_builds_the_plan_without_running_jobs(spark):
    sc = spark.sparkContext
    tracker = sc.statusTracker()

    def jobs_while(fn):
        group = f"lazy-{id(fn)}"
        sc.setJobGroup(group, group)
        try:
            fn()
        finally:
            sc.setJobGroup("after", "after")
        return len(tracker.getJobIdsForGroup(group))

    raw = testdata.listings_raw(spark, SF001)
    assert jobs_while(lambda: clean_listings(raw, ListingsParams(quantile_method="sketch"))) == 0
    assert jobs_while(lambda: clean_listings(raw)) > 0


def test_etl_modes_agree(spark):
    """Sequential and concurrent runs, and every verification level, give
    the same tables and the same observed figures; a file count adds a
    repartition above which the written rows are still counted once."""
    raw = (
        testdata.listings_raw(spark, SF001),
        testdata.neighbourhoods_raw(spark, SF001),
        testdata.reviews_raw(spark, SF001),
    )
    runs = [
        run_etl(spark, *raw, scratch_dir(spark, "etl-par"), parallel=True),
        run_etl(spark, *raw, scratch_dir(spark, "etl-seq"), parallel=False, verify="count"),
        run_etl(spark, *raw, scratch_dir(spark, "etl-nov"), verify=None, files={"reviews": 3}),
    ]
    assert runs[2].verification is None
    assert all(r.content_ok for r in runs[1].verification.collect())  # count level: schema + rows
    first = runs[0]
    for other in runs[1:]:
        assert sorted(other.accounting.collect()) == sorted(first.accounting.collect())
        assert {k: v["rows"] for k, v in other.written.items()} == {k: v["rows"] for k, v in first.written.items()}
        for name in first.paths:
            a = spark.read.parquet(first.paths[name])
            b = spark.read.parquet(other.paths[name])
            assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr), name
    files = [f for f in spark.read.parquet(runs[2].paths["reviews"]).inputFiles() if f.endswith(".parquet")]
    assert len(files) == 3
