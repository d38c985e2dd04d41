"""The store of derived tables, type inference, layout, differences, states."""

import glob
import math
import os
import uuid

import pyarrow.parquet as pq
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from brightwash.operators import analytics, states
from brightwash.operators.difference import _cover, Range, table_differences, unequal_ranges
from brightwash.operators.joins import anti_join_keys, bytes_at_most
from brightwash.operators.overview import listing_overview
from brightwash.operators.trends import monthly_trend
from brightwash.plans import queries
from brightwash.sources import inference, layout, planning, testdata
from brightwash.sources.store import TableStore


def jobs_of(spark, work):
    """The result of ``work`` and the number of jobs that it started."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# --- store -------------------------------------------------------------------


def test_second_question_of_the_clean_table_costs_one_job_more(spark):
    """Beside the jobs that the question itself takes of a stored table (four for
    a sorted group count), a hit lists the sources and versions in one."""
    stored = queries.stored_clean_table(spark, SF001)  # somebody asked before
    plain = lambda: analytics.group_count(spark.read.schema(stored.data.schema).parquet(stored.path), "room_type").collect()
    expected, own = jobs_of(spark, plain)
    rows, jobs = jobs_of(spark, lambda: queries.QUERIES["group_count"](spark, SF001).collect())
    assert rows == expected and jobs == own + 1
    _, jobs = jobs_of(spark, lambda: queries.QUERIES["price_overall"](spark, SF001).collect())
    assert jobs <= 3


def test_store_hits_and_misses(spark, tmp_path):
    source, built = str(tmp_path / "src"), []
    spark.range(10).write.parquet(source)
    store = TableStore(spark, str(tmp_path / "store"))

    def get(params=None, store=store):
        def build():
            built.append(params)
            return spark.read.parquet(source).selectExpr("id", f"'{params}' AS p")

        found = store.get("t", [source], build, params)
        return found.hit, sorted(r.id for r in found.data.collect())

    assert get() == (False, list(range(10)))
    assert get() == (True, list(range(10)))
    assert get("other")[0] is False and get("other")[0] is True and get()[0] is True
    # another session's view of the same folder
    assert get(store=TableStore(spark, str(tmp_path / "store")))[0] is True
    # a source file more, and a source file rewritten
    spark.range(10, 12).write.mode("append").parquet(source)
    assert get() == (False, list(range(12))) and get()[0] is True
    file = sorted(glob.glob(source + "/*.parquet"))[0]
    os.utime(file, (1, 1))
    assert get()[0] is False
    assert built == [None, "other", None, None]


def test_unfinished_and_repeated_writes(spark, tmp_path):
    source, root = str(tmp_path / "src"), str(tmp_path / "store")
    spark.range(3).write.parquet(source)
    store = TableStore(spark, root)
    read = lambda: spark.read.parquet(source)
    first = store.get("t", [source], read)
    for marker in glob.glob(first.path.replace("/data/", "/commits/") + "/part*"):
        os.remove(marker)  # the write died before its commit
    assert not store.get("t", [source], read).hit
    # two writers at once: both commit, all readers take the same copy
    twin = os.path.join(os.path.dirname(first.path), "0" * 32)
    read().write.parquet(twin)
    spark.range(1).selectExpr("'x'").write.text(twin.replace("/data/", "/commits/"))
    assert store.get("t", [source], read).path.endswith("0" * 32)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        store.get("t", [str(tmp_path / "nowhere")], read)


# --- inference -----------------------------------------------------------------


def test_outcomes(spark):
    cases = {
        None: None, "": None, "NULL": None, "true": "boolean", "FALSE": "boolean", "0": "int", "-7": "int", "+7": "int",
        "2147483648": "bigint", "99999999999999999999": "double", "1.5": "double", ".5": "double", "2.": "double", "1e3": "double",
        "1.2.3": "string", "1995-02-28": "date", "1995-02-30": "string", "1995-02-28 10:11": "timestamp",
        "1995-02-28T10:11:12.5": "timestamp", "2020": "int", "x": "string", " 1": "string", "NaN": "string",
    }
    frame = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.o for r in frame.select("v", inference.outcome(F.col("v")).alias("o")).collect()} == cases


def test_types_follow_from_merged_states(spark):
    a = spark.createDataFrame([("1", "2020-01-01", "x", None, "1"), ("2", "", "1", "", "2.5")], "a string, b string, c string, d string, e string")
    b = spark.createDataFrame([("3000000000", "2020-01-01 00:00", "2", "NULL", "z")], a.schema)
    parts = [inference.type_states(t) for t in (a, b)]
    merged, whole = inference.merge_states(*parts), inference.type_states(a.unionByName(b))
    key = lambda r: (r.position, r["outcome"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert inference.inferred_types(whole) == {"a": "bigint", "b": "timestamp", "c": "string", "d": "string", "e": "string"}
    loose = {r["column"]: (r.type, r.filled, r.misfits, r.corrupt_rows) for r in inference.infer_types(whole, 0.34).collect()}
    assert loose == {"a": ("int", 3, 1, 0), "b": ("timestamp", 2, 0, 0), "c": ("int", 3, 1, 0), "d": ("string", 0, 0, 0), "e": ("double", 3, 1, 0)}


def test_quarantine_holds_what_the_typed_table_lacks(spark):
    rows = [("1", "5", None), ("x", "y", None), ("2", "NULL", None), ("9", "9", "9,9,9")]
    frame = spark.createDataFrame(rows, "misfits string, b string, bad string")
    out = inference.apply_types(frame, {"misfits": "int", "b": "int"}, "bad", carry=("b",))
    assert sorted(map(tuple, out.typed.collect())) == [(1, 5), (2, None)] and dict(out.typed.dtypes) == {"misfits": "int", "b": "int"}
    assert sorted(map(str, map(tuple, out.quarantine.collect()))) == sorted(map(str, [("y", "misfits", "x"), ("y", "b", "y"), ("9", None, "9,9,9")]))
    empty = inference.infer_types(inference.type_states(frame.limit(0), "bad")).collect()
    assert [(r.type, r.filled, r.misfits) for r in empty] == [("string", 0, 0)] * 2


# --- layout --------------------------------------------------------------------


def row_groups(path, inside):
    """Row groups of the files under ``path``, and those whose bounds meet a box."""
    total = met = 0
    for file in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {c.path_in_schema: c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns))}
            total += 1
            met += all(stats[c].max >= low and stats[c].min <= high for c, (low, high) in inside.items())
    return total, met


def test_a_box_reads_few_row_groups(spark, tmp_path):
    box = {"latitude": (-33.55, -33.45), "longitude": (-70.6, -70.4)}
    located = testdata.listings_raw(spark, "/root/testdata/sf0.01").filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    located = located.select("id", "latitude", "longitude")
    layout.write_clustered(located, str(tmp_path / "curve"), ["latitude", "longitude"], files=32)
    located.repartition(32).write.parquet(str(tmp_path / "plain"))
    total, met = row_groups(str(tmp_path / "curve"), box)
    assert total == 32 and met < 0.3 * total
    assert row_groups(str(tmp_path / "plain"), box) == (32, 32)
    back = spark.read.parquet(str(tmp_path / "curve"))
    inside = F.col("latitude").between(*box["latitude"]) & F.col("longitude").between(*box["longitude"])
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = back.filter(inside)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(latitude,-33.55)" in plan and "LessThanOrEqual(longitude,-70.4)" in plan
    assert back.filter(inside).count() == located.filter(inside).count() and back.count() == located.count()


def test_curve_key_of_odd_values(spark):
    rows = [(None, 1.0), (float("nan"), 2.0), (float("inf"), 0.0), (-1e308, 5.0), (1e308, 5.0), (3.0, None)]
    frame = spark.createDataFrame(rows, "x double, y double")
    bounds = layout.value_bounds(frame, ["x", "y"])
    assert bounds == [(-1e308, 1e308), (0.0, 5.0)]
    keys = [r[0] for r in frame.select(layout.curve_key(["x", "y"], bounds)).collect()]
    assert all(0 <= k < 1 << 60 for k in keys)
    assert layout.value_bounds(frame.limit(0), ["x"]) == [None]
    assert frame.select(layout.curve_key(["x"], [None])).distinct().count() == 1


def test_curve_key_interleaves_bits(spark):
    n = 8
    frame = spark.range(n * n).selectExpr(f"id % {n} AS x", f"id DIV {n} AS y")
    key = layout.curve_key(["x", "y"], [(0, n - 1), (0, n - 1)])
    order = [(r.x, r.y) for r in frame.orderBy(key).collect()]
    zorder = lambda p: sum(((p[0] >> b) & 1) << 2 * b | ((p[1] >> b) & 1) << 2 * b + 1 for b in range(3))
    assert order == sorted(order, key=zorder)


# --- differences -----------------------------------------------------------------


def differences(left, right, **kw):
    return sorted(map(tuple, table_differences(left, right, "k", **kw).collect()), key=str)


@pytest.mark.parametrize("leaf_rows", [1, 40, 10**6])
def test_differences_of_each_kind(spark, leaf_rows):
    left = spark.range(0, 300_000, 3).selectExpr("id AS k", "id % 7 AS a", "CAST(id AS STRING) AS b")
    right = left.filter("k <> 3000").selectExpr("k", "CASE WHEN k = 60000 THEN NULL ELSE a END AS a", "CASE WHEN k IN (60000, 90000) THEN 'z' ELSE b END AS b")
    more = spark.createDataFrame([(-5, 1, "n"), (10**15, 1, "f"), (9, 2, "9"), (None, 1, "null key")], "k long, a long, b string")
    expected = [
        (-5, "added", 0, 1, None), (10**15, "added", 0, 1, None), (3000, "removed", 1, 0, None), (60000, "changed", 1, 1, "a,b"),
        (9, "changed", 1, 2, None), (90000, "changed", 1, 1, "b"), (None, "added", 0, 1, None),
    ]
    assert differences(left, right.unionByName(more), leaf_rows=leaf_rows) == sorted(expected, key=str)


def test_equal_tables_cost_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("id AS k", "id % 11 AS v").write.parquet(path)
    a, b = spark.read.parquet(path), spark.read.parquet(path).repartition(7)
    (ranges, nulls), jobs = jobs_of(spark, lambda: unequal_ranges(a, b, "k"))
    assert (ranges, nulls) == ([], False) and jobs <= 8  # the bounds, and one sum of each table
    assert differences(a, b) == []
    assert differences(a.limit(0), b.limit(0)) == [] and len(differences(a.limit(0), b.filter('k < 4'))) == 4


def test_differences_open_only_unequal_ranges(spark):
    """One row of a million differs: the ranges found are small."""
    left = spark.range(1_000_000).selectExpr("id AS k", "id AS v")
    right = left.selectExpr("k", "CASE WHEN k = 765432 THEN 0 ELSE v END AS v")
    ranges, _ = unequal_ranges(left, right, "k", leaf_rows=100)
    assert sum(r.high - r.low + 1 for r in ranges) <= 256 and ranges[0].low <= 765432 <= ranges[0].high


def test_cover_keeps_the_widest_gaps():
    ranges = [Range(0, 1), Range(2, 3), Range(10, 11), Range(100, 101)]
    assert _cover(ranges, 2) == [Range(0, 11), Range(100, 101)]
    assert _cover(ranges, 9) == [Range(0, 3), Range(10, 11), Range(100, 101)] and _cover([], 3) == []


# --- states ----------------------------------------------------------------------


def test_only_new_files_are_read(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path / "states")
    wave = lambda low, high: spark.range(low, high).selectExpr("id", "1e9 + id % 100 AS v", "CASE WHEN id % 4 = 0 THEN NULL ELSE 'w' || id % 50 END AS w").repartition(3)
    wave(0, 1000).write.parquet(path)
    assert states.refresh_states(spark, path, root).files_read == 3
    assert states.refresh_states(spark, path, root).files_read == 0
    wave(1000, 1600).write.mode("append").parquet(path)
    refreshed = states.refresh_states(spark, path, root)
    assert refreshed.files_read == 3
    profile = {r.column_name: r for r in states.table_profile(refreshed.states).collect()}
    direct = spark.read.parquet(path).agg(F.avg("v"), F.stddev_samp("v"), F.min("v"), F.max("v")).first()
    v, w = profile["v"], profile["w"]
    assert (v.rows, v.nulls, v.numbers, v.low, v.high) == (1600, 0, 1600, direct[2], direct[3])
    assert math.isclose(v.mean, direct[0], abs_tol=1e-5) and math.isclose(v.stddev, direct[1], abs_tol=1e-5)
    assert abs(v.median - (1e9 + 50)) <= 3 and abs(v.distinct_values - 100) <= 3
    assert (w.rows, w.nulls, w.numbers, w.low, w.mean) == (1600, 400, 0, None, None)
    assert [tuple(r) for r in states.top_null_columns(refreshed.states, 2).collect()] == [("w", 400), ("id", 0)]
    # a file that is gone or rewritten
    os.remove(sorted(glob.glob(path + "/*.parquet"))[0])
    again = states.refresh_states(spark, path, root)
    assert again.files_read == 0
    assert states.table_profile(again.states).first().rows == spark.read.parquet(path).count() < 1600
    with pytest.raises(ValueError, match="no files"):
        os.makedirs(tmp_path / "none")
        states.refresh_states(spark, str(tmp_path / "none"), str(tmp_path / "s2"))


# --- stream with keyed state ---------------------------------------------------------


def test_keyed_stream_dedup_across_batches(spark, tmp_path):
    """Repeats within a batch, across batches and across runs, a row that is a
    third of the feed, NULLs; the sink is written but never read."""
    from brightwash.streaming import review_stream, start_keyed_dedup

    source, sink, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id % 700 END AS listing_id",
        "CASE WHEN id % 40 = 1 THEN NULL ELSE date_add(DATE'2020-01-01', CAST(id % 5 AS INT)) END AS date",
    )
    expected = sorted(map(str, rows.distinct().collect()))
    for wave in range(2):
        rows.repartition(4).write.mode("append").parquet(source)
        query = start_keyed_dedup(review_stream(spark, source, max_files_per_trigger=3), sink, ckpt)
        query.awaitTermination()
        assert query.exception() is None
        assert sorted(map(str, spark.read.parquet(sink).collect())) == expected
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(progress) >= 2 and all(len(p["sources"]) == 1 for p in progress)
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == len(expected)
    assert "RocksDB" in str(progress[-1]["stateOperators"][0]["customMetrics"]) or "rocksdb" in str(progress[-1]["stateOperators"][0]["customMetrics"])


# --- overview, trends, joins, files --------------------------------------------------


def test_overview_scans_once(spark):
    clean = queries.clean_table(spark, SF001)
    plan = listing_overview(clean)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    assert listing_overview(clean.limit(0)).count() <= 1


def test_trend_fills_empty_months(spark):
    rows = [("a", "2020-11-30"), ("a", "2021-02-01"), ("a", "2021-02-15"), ("b", "2020-01-05"), (None, "2020-01-01"), ("c", None)]
    frame = spark.createDataFrame(rows, "k string, d string")
    got = [tuple(r) for r in monthly_trend(frame, "k", "d").orderBy("k", "month").select("k", F.col("month").cast("string"), "rows", "moving_mean", "change", "share_of_peak").collect()]
    assert got == [
        ("a", "2020-11-01", 1, 1.0, None, 1.0), ("a", "2020-12-01", 0, 0.5, -1, 0.0), ("a", "2021-01-01", 0, 0.333333, 0, 0.0),
        ("a", "2021-02-01", 2, 0.666667, 2, 1.0), ("b", "2020-01-01", 1, 1.0, None, 1.0),
    ]
    assert monthly_trend(frame.limit(0), "k", "d").collect() == []


def test_anti_join_over_distinct_keys(spark):
    facts = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id = 1 THEN NULL ELSE id END AS k", "id")
    dim = spark.range(8, 5000).selectExpr("id AS k").unionByName(spark.range(2000).selectExpr("CAST(NULL AS BIGINT) AS k"))
    expected = sorted(r.id for r in facts.collect() if r.k is None or r.k < 8)
    for rows in (100_000, 0):
        found = anti_join_keys(facts, dim, "k", max_rows=rows)
        assert sorted(r.id for r in found.collect()) == expected and found.columns == ["k", "id"]
    plan = anti_join_keys(facts, dim, "k", max_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan.split("Union")[0] or "hint" not in plan


def test_size_checks_look_at_bytes(spark):
    wide = spark.range(100).selectExpr("id", "repeat('x', 1000) AS s", "CAST(NULL AS STRING) AS n")
    assert bytes_at_most(wide, 100, 200_000) and not bytes_at_most(wide, 100, 90_000) and not bytes_at_most(wide, 99, 200_000)


def test_planned_and_compacted_files(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(10_000).selectExpr("id", "uuid() AS file", "id AS bin")
    rows.write.parquet(str(tmp_path / "src"))
    rows = spark.read.parquet(str(tmp_path / "src"))
    assert planning.write_planned(rows, path, rows_per_file=1500) == 7 == len(glob.glob(path + "/*.parquet"))
    sized = str(tmp_path / "sized")
    planned = planning.write_planned(rows, sized, target_bytes=100_000, sample_path=str(tmp_path / "sample"))
    sizes = [os.path.getsize(f) for f in glob.glob(sized + "/*.parquet")]
    assert planned == len(sizes) and 30_000 < min(sizes) and max(sizes) < 200_000
    out = str(tmp_path / "out")
    files = planning.compact(spark, path, out, target_bytes=200_000)
    assert 1 < files == len(glob.glob(out + "/*.parquet")) < 7
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError, match="sample_path"):
        planning.write_planned(rows, path)


def test_plan_bins_are_neither_large_nor_tiny(spark):
    sizes = [5, 40, 3, 60, 45, 20, 20, 100, 49, 10, 30]
    files = spark.createDataFrame([(f"f{i}", "d", s) for i, s in enumerate(sizes)], "file string, folder string, bytes long")
    bins = {}
    for r in planning.compaction_plan(files, 100).collect():
        bins.setdefault(r.bin, []).append(r.bytes)
    assert sorted(sum(bins.values(), [])) == sorted(sizes) and max(map(sum, bins.values())) <= 100
    assert bins["f3"] == [60] and bins["f7"] == [100]
