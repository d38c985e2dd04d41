"""DataFrame operators on small literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from brightwash.config import Box
from brightwash.operators import (
    band_distribution,
    convert_types,
    dedup_by_key,
    dedup_rows,
    describe_numeric,
    duplicate_stats,
    geo_profile,
    group_count,
    has_at_most,
    join_dimension,
    monthly_counts,
    null_counts,
    null_profile,
    orphans,
    outside_sample,
    preview,
    reduction_table,
    review_stats,
    row_counts,
    schema_table,
    table_profile,
    top_expensive,
    top_nulls,
    value_by_group,
)


def test_convert_types_guards_missing_columns(spark):
    df = spark.createDataFrame([("1", "2.5")], "id string, lat string")
    out = convert_types(df, {"id": "bigint", "lat": "double", "absent": "int"})
    assert out.dtypes == [("id", "bigint"), ("lat", "double")]
    assert out.first() == (1, 2.5)


def test_full_row_dedup_semantics(spark):
    rows = [(1, None), (1, None), (1, 0.0), (1, -0.0), (2, float("nan")), (2, float("nan"))]
    df = spark.createDataFrame(rows, "k int, v double")
    assert dedup_rows(df).count() == 3
    stats = duplicate_stats(df).first()
    assert (stats.rows, stats.distinct_rows, stats.duplicates) == (6, 3, 3)


def test_duplicate_stats_empty(spark):
    df = spark.createDataFrame([], "k int, v double")
    stats = duplicate_stats(df).first()
    assert (stats.rows, stats.distinct_rows, stats.duplicates) == (0, 0, 0)


def test_dedup_by_key_keeps_first_and_handles_hot_key(spark):
    rows = [(1, dt.date(2020, 1, 1), o) for o in range(300, 0, -1)] + [(2, dt.date(2020, 1, 2), 9)]
    df = spark.createDataFrame(rows, "listing_id long, date date, l_orderkey long").repartition(5)
    out = dedup_by_key(df, ["listing_id", "date"], ["l_orderkey"])
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, dt.date(2020, 1, 1), 1),
        (2, dt.date(2020, 1, 2), 9),
    ]


def test_dedup_by_key_carries_other_columns(spark):
    rows = [(1, 5, "late"), (1, 2, "b"), (1, 2, "a"), (2, 7, "x")]
    df = spark.createDataFrame(rows, "k long, o long, payload string")
    out = dedup_by_key(df, ["k"], ["o"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "a"), (2, 7, "x")]


def test_null_profile_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, None)], "a int, b string")
    assert [tuple(r) for r in null_profile(df).collect()] == [(0, "a", 2), (1, "b", 2)]
    assert null_counts(df).first().asDict() == {"a": 2, "b": 2}
    empty = spark.createDataFrame([], "a int, b string")
    assert null_counts(empty).first().asDict() == {"a": 0, "b": 0}
    assert table_profile(empty).first().asDict() == {"rows": 0, "a_nulls": 0, "b_nulls": 0}


def test_geo_profile_empty_has_null_share(spark):
    empty = spark.createDataFrame([], "latitude double, longitude double")
    row = geo_profile(empty, Box()).first()
    assert row.rows == 0 and row.out_of_range == 0 and row.pct_out_of_range is None


def test_geo_profile_and_sample(spark):
    rows = [(i, f"n{i}", "x", -33.5 if i % 2 else -35.0, -70.5) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, name string, neighbourhood string, latitude double, longitude double")
    row = geo_profile(df, Box()).first()
    assert row.out_of_range == 15 and row.pct_out_of_range == 50.0
    assert [r.id for r in outside_sample(df, Box(), n=3).collect()] == [0, 2, 4]


def test_describe_numeric_typed(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    rows = {r.column_name: r for r in describe_numeric(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 2 and rows["a"]["mean"] == 2.0 and rows["a"]["max"] == 3.0
    assert rows["b"]["count"] == 1 and rows["b"]["stddev"] is None


def test_group_queries_tie_break_and_having(spark):
    rows = [("A", "r1", 10.0)] * 3 + [("B", "r1", 30.0)] * 3 + [("C", "r2", None)] * 2
    df = spark.createDataFrame(rows, "neighbourhood string, room_type string, price double")
    assert [tuple(r) for r in group_count(df, "neighbourhood").collect()] == [("A", 3), ("B", 3), ("C", 2)]
    assert [tuple(r) for r in top_expensive(df, min_count=3, k=5).collect()] == [("B", 30.0, 3), ("A", 10.0, 3)]
    bands = {(r.room_type, r.rango_precio): r.cantidad for r in band_distribution(df).collect()}
    assert bands[("r2", "Premium (>100k)")] == 2
    by = value_by_group(df, "room_type").collect()
    assert by[0].room_type == "r1" and by[0].cantidad == 6 and by[1].cantidad == 0


def test_review_stats_rounding(spark):
    rows = [("A", 1, 0.5, 10.0), ("A", 2, 0.25, 11.0)]
    df = spark.createDataFrame(rows, "neighbourhood string, number_of_reviews int, reviews_per_month double, price double")
    r = review_stats(df, min_count=2, k=10).first()
    assert (r.total_propiedades, r.promedio_resenas, r.resenas_por_mes, r.precio_promedio) == (2, 1.5, 0.38, 11.0)


def test_orphans_anti_join_and_checked_broadcast(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, neighbourhood string")
    dim = spark.createDataFrame([("x", "a")], "neighbourhood_group string, neighbourhood string")
    assert sorted(r.id for r in orphans(facts, dim).collect()) == [2, 3]
    assert has_at_most(dim, 1) and not has_at_most(facts, 2)
    # beyond the bound the join still runs (no broadcast)
    joined = join_dimension(facts, dim.select("neighbourhood"), "neighbourhood", max_rows=0)
    assert joined.count() == 1


def test_monthly_counts(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 5)), (2, dt.date(2020, 1, 31)), (3, dt.date(2020, 2, 1))],
        "listing_id long, date date",
    )
    assert [tuple(r) for r in monthly_counts(df).collect()] == [
        (dt.date(2020, 1, 1), 2),
        (dt.date(2020, 2, 1), 1),
    ]


def test_reduction_table_and_top_nulls(spark):
    raw = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 1.0, None)], "id long, p double, extra string")
    clean = raw.filter(F.col("id") > 1).drop("extra")
    empty = spark.createDataFrame([], "id long")
    red = {r.dataset: r for r in reduction_table([("t", raw, clean), ("e", empty, empty)]).collect()}
    assert (red["t"].initial, red["t"].final, red["t"].pct_reduction) == (3, 2, 33.33)
    assert red["e"].pct_reduction == 0.0
    top = [tuple(r) for r in top_nulls(raw, clean, k=2).collect()]
    assert top == [("extra", 2, 0), ("p", 2, 1)]


def test_row_counts_schema_preview(spark):
    a = spark.createDataFrame([(2,), (1,)], "id long")
    assert {r.dataset: r.rows for r in row_counts({"a": a, "b": a.limit(0)}).collect()} == {"a": 2, "b": 0}
    assert [tuple(r) for r in schema_table(spark, a).collect()] == [(0, "id", "bigint", True)]
    assert [r.id for r in preview(a, ["id"], 1, ["id"]).collect()] == [1]


def test_clean_price_on_numeric_column_is_a_cast(spark):
    from brightwash.operators.price import add_clean_price

    df = spark.createDataFrame([(1.0e7,), (0.75,), (None,)], "price double")
    assert [r.price_clean for r in add_clean_price(df).collect()] == [1.0e7, 0.75, None]
