"""Plan-shape checks: the properties the engine relies on at scale.

They read ``explain("formatted")`` text, so a change that loses pushdown,
adds a shuffle or drops the map-side aggregate fails here.
"""

import io
from contextlib import redirect_stdout

import pytest

from brightwash.config import LISTING_TYPES, ListingsParams
from brightwash.operators import analytics, dedup
from brightwash.operators.types import convert_types
from brightwash.plans.clean import clean_listings, clean_reviews
from brightwash.session import scratch_dir
from brightwash.sources import testdata, write_parquet
from conftest import SF001


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def typed_source(spark):
    path = scratch_dir(spark, "typed-listings")
    write_parquet(convert_types(testdata.listings_raw(spark, SF001), LISTING_TYPES), path)
    return spark.read.parquet(path)


def test_cleaning_is_one_stage_with_pushed_box_filters(typed_source):
    text = plan_text(clean_listings(typed_source).data)
    assert "Exchange" not in text
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    for bound in ("GreaterThanOrEqual(latitude,-33.8)", "LessThanOrEqual(longitude,-70.2)",
                  "IsNotNull(latitude)", "IsNotNull(longitude)"):
        assert bound in pushed


def test_counters_do_not_reach_the_final_scan(typed_source):
    text = plan_text(clean_listings(typed_source, observe=True).data)
    assert "CollectMetrics" not in text and "Exchange" not in text
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(latitude,-33.8)" in pushed and "IsNotNull(longitude)" in pushed


def test_dimension_queries_run_their_operator(spark):
    from brightwash.plans.queries import QUERIES

    assert "isnull(" in plan_text(QUERIES["null_group_rows"](spark, SF001)).lower()
    assert "coalesce(" in plan_text(QUERIES["fill_dimension"](spark, SF001)).lower()


def test_analytics_read_only_needed_columns_and_aggregate_map_side(typed_source):
    text = plan_text(analytics.top_expensive(clean_listings(typed_source).data))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert schema == "ReadSchema: struct<neighbourhood:string,latitude:double,longitude:double,price:string>"
    assert "partial_avg" in text and "TakeOrderedAndProject" in text


def test_approx_quantiles_stay_in_the_plan(typed_source):
    text = plan_text(clean_listings(typed_source, ListingsParams(quantile_method="sketch")).data)
    assert "Subquery" in text and "kll_merge_agg_double" in text


def test_dedups_combine_map_side(spark):
    reviews = testdata.reviews_raw(spark, SF001, with_order=True)
    for df in (
        clean_reviews(reviews.drop("l_orderkey")),
        dedup.duplicate_stats(reviews.drop("l_orderkey")),
        dedup.dedup_by_key(reviews, ["listing_id", "date"], ["l_orderkey"]),
    ):
        text = plan_text(df)
        physical = text.split("\n\n")[0]
        assert physical.count("HashAggregate") >= 2  # partial below the exchange, final above
        assert "Window" not in text and "Sort " not in physical


def test_integrity_check_is_a_broadcast_anti_join(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, neighbourhood string")
    dim = testdata.neighbourhoods_raw(spark, SF001)
    text = plan_text(analytics.orphans(facts, dim))
    assert "BroadcastHashJoin LeftAnti" in text


def test_prices_are_parsed_once_a_row(spark):
    raw = testdata.listings_raw(spark, SF001)
    for df in (clean_listings(raw).data, clean_listings(raw).stages["priced"].filter("price_clean IS NOT NULL")):
        conditions = [line for line in plan_text(df).splitlines() if line.startswith(("Condition", "Join condition"))]
        assert conditions and not [line for line in conditions if "regexp_replace" in line]


def test_duplicates_after_cleaning_are_counted_in_tasks_of_their_own(spark):
    from brightwash.plans.queries import QUERIES

    # the second grouping does not stand on top of the deduplication's
    assert "REPARTITION_BY_NUM" in plan_text(QUERIES["duplicates_before_after"](spark, SF001))
    rows = spark.range(1000).selectExpr("id % 300 AS a", "CASE WHEN id % 2 = 0 THEN id % 5 END AS b")
    distinct = dedup.dedup_rows(rows)
    dealt = dedup.dealt_by_row(distinct, 1000, rows_per_task=100)
    assert dealt.rdd.getNumPartitions() == 10
    assert dealt.exceptAll(distinct).isEmpty() and distinct.exceptAll(dealt).isEmpty()
    assert dedup.dealt_by_row(distinct.limit(0), 0).count() == 0
