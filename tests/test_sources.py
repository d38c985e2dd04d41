"""CSV / Parquet input and output, verification, catalog helpers, streaming."""

import os

from pyspark.sql import functions as F

from brightwash.session import scratch_dir
from brightwash.sources import (
    assert_verified,
    load_or_build,
    read_csv,
    register_views,
    table_exists,
    verify_written,
    write_csv,
    write_parquet,
    write_parquet_observed,
)
from brightwash.sources.schemas import LISTINGS_CLEAN, LISTINGS_RAW, NEIGHBOURHOODS, REVIEWS
from brightwash.streaming import new_reviews, review_stream, start_review_dedup


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_quoted_quotes_and_line_break(spark):
    folder = _local(scratch_dir(spark, "csv-unit"))
    os.makedirs(folder)
    with open(os.path.join(folder, "t.csv"), "w", encoding="utf-8") as fh:
        fh.write('id,name\n1,"Casa ""Azul""\nsegunda línea"\n')
    schema = "id string, name string"
    whole = read_csv(spark, folder, schema=spark.createDataFrame([], schema).schema, multi_line=True).collect()
    assert len(whole) == 1 and whole[0].name == 'Casa "Azul"\nsegunda línea'
    broken = read_csv(spark, folder, schema=spark.createDataFrame([], schema).schema, multi_line=False)
    assert broken.count() == 2


def test_csv_roundtrip_keeps_empty_vs_null(spark):
    path = scratch_dir(spark, "csv-rt")
    df = spark.createDataFrame([("", None), ("a", "b")], "x string, y string")
    write_csv(df, path, null_value=r"\N")
    back = read_csv(spark, path, schema=df.schema, null_value=r"\N")
    assert sorted(back.collect()) == sorted(df.collect())


def test_parquet_write_verify_and_detect_changes(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "id long, v double")
    path = scratch_dir(spark, "pq")
    written = write_parquet_observed(df, path, files=3)
    assert written["rows"] == 100
    assert len([f for f in os.listdir(_local(path)) if f.endswith(".parquet")]) == 3
    assert_verified(verify_written(spark, path, written, df.schema))
    # same row count, one value changed: the checksum catches it
    other = df.withColumn("v", F.when(F.col("id") == 5, F.lit(-1.0)).otherwise(F.col("v")))
    write_parquet(other, path)
    check = verify_written(spark, path, written, df.schema).first()
    assert check.rows_read == 100 and check.schema_ok and not check.content_ok


def test_partitioned_write_prunes_folders(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, room_type string")
    path = scratch_dir(spark, "pq-part")
    write_parquet(df, path, partition_by=("room_type",))
    assert sorted(d for d in os.listdir(_local(path)) if d.startswith("room_type=")) == [
        "room_type=a",
        "room_type=b",
    ]
    read = spark.read.parquet(path).filter(F.col("room_type") == "a")
    files = {r.f for r in read.select(F.input_file_name().alias("f")).collect()}
    assert files and all("room_type=a" in f for f in files)
    assert sorted(r.id for r in read.collect()) == [1, 3]


def test_load_or_build_and_views(spark):
    path = scratch_dir(spark, "lob")
    built = load_or_build(spark, path, lambda: spark.range(3).withColumnRenamed("id", "x"))
    assert built.count() == 3
    write_parquet(built, path)
    loaded = load_or_build(spark, path, lambda: spark.range(0))
    assert loaded.count() == 3
    register_views({"lob_view": loaded})
    assert table_exists(spark, "lob_view") and not table_exists(spark, "no_such_view")


def test_schemas_shape():
    assert len(LISTINGS_RAW) == 18 and LISTINGS_CLEAN.names[-1] == "price"
    assert NEIGHBOURHOODS.names == ["neighbourhood_group", "neighbourhood"]
    assert REVIEWS.names == ["listing_id", "date"]


import pytest


@pytest.mark.parametrize("by_date", [False, True])
def test_stream_dedup_is_exact_across_batches_and_replays(spark, by_date):
    import datetime as dt

    source = scratch_dir(spark, "feed")
    sink = scratch_dir(spark, "sink")
    ckpt = scratch_dir(spark, "ckpt")
    d = dt.date(2020, 1, 1)
    wave1 = spark.createDataFrame([(1, d), (1, d), (2, d)], REVIEWS)
    wave2 = spark.createDataFrame([(1, d), (3, d), (None, None)], REVIEWS)
    wave1.write.mode("append").parquet(source)
    stream = review_stream(spark, source, max_files_per_trigger=1)
    start_review_dedup(stream, sink, ckpt, partition_by_date=by_date).awaitTermination()
    wave2.write.mode("append").parquet(source)
    stream = review_stream(spark, source, max_files_per_trigger=1)
    start_review_dedup(stream, sink, ckpt, partition_by_date=by_date).awaitTermination()
    stored = spark.read.schema(REVIEWS).parquet(sink).select(*REVIEWS.names)
    got = sorted(stored.collect(), key=lambda r: (r.listing_id is None, r.listing_id or 0))
    assert [r.listing_id for r in got] == [1, 2, 3, None]
    assert [r.date for r in got] == [d, d, d, None]
    # replaying a batch writes nothing twice
    assert new_reviews(wave1.unionByName(wave2), stored).count() == 0


def test_neighbourhood_csv_all_empty_group_and_non_ascii(spark):
    from brightwash.plans.clean import clean_neighbourhoods

    folder = _local(scratch_dir(spark, "neigh-csv"))
    os.makedirs(folder)
    names = ["Barrio Ñandú", "Colón Alto", "Quebrada Árida"] + [f"Sector {i}" for i in range(29)]
    with open(os.path.join(folder, "n.csv"), "w", encoding="utf-8") as fh:
        fh.write("neighbourhood_group,neighbourhood\n")
        fh.writelines(f",{n}\n" for n in names)
    inferred = read_csv(spark, folder)
    assert inferred.dtypes == [("neighbourhood_group", "string"), ("neighbourhood", "string")]
    typed = read_csv(spark, folder, schema=NEIGHBOURHOODS)
    clean = clean_neighbourhoods(typed)
    rows = clean.collect()
    assert len(rows) == 32
    assert {r.neighbourhood_group for r in rows} == {"Grupo_No_Especificado"}
    assert {r.neighbourhood for r in rows} == set(names)


def test_count_only_verification(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "id long")
    path = scratch_dir(spark, "pq-count")
    written = write_parquet_observed(df, path)
    check = verify_written(spark, path, written, df.schema, content=False).first()
    assert check.rows_read == 10 and check.schema_ok and check.content_ok
    bad = verify_written(spark, path, {"rows": 11, "checksum": 0}, df.schema, content=False)
    try:
        assert_verified(bad)
        raise AssertionError("mismatch not detected")
    except AssertionError as exc:
        assert "differs" in str(exc)


def test_session_sizing_and_existence_checks(spark):
    from brightwash.session import checkpoint_root
    from brightwash.sources import read_parquet_if_present

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    root = checkpoint_root(spark)
    assert root and checkpoint_root(spark) == root
    path = scratch_dir(spark, "exists")
    assert path.startswith(root)
    assert read_parquet_if_present(spark, path) is None
    spark.range(2).write.parquet(path)
    assert read_parquet_if_present(spark, path).count() == 2
    # without the commit marker the folder is a half-written table
    half = scratch_dir(spark, "half")
    spark.range(2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert read_parquet_if_present(spark, half) is None


def test_live_table_comes_first(spark):
    from brightwash.sources import load_or_build

    path = scratch_dir(spark, "resolve")
    build = lambda: spark.range(1)
    assert load_or_build(spark, path, build, "no_such_view").count() == 1
    spark.range(2).write.parquet(path)
    assert load_or_build(spark, path, build, "no_such_view").count() == 2
    spark.range(3).createOrReplaceTempView("live_numbers")
    assert load_or_build(spark, path, build, "live_numbers").count() == 3


def test_scratch_folder_must_be_named_off_a_local_master(spark, monkeypatch):
    from brightwash import session

    class Cluster:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Cluster()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_checksum_sees_moved_nulls(spark):
    from brightwash.sources.files import table_fingerprint

    a = spark.createDataFrame([(None, 1)], "a int, b int")
    b = spark.createDataFrame([(1, None)], "a int, b int")
    assert table_fingerprint(a).first().checksum != table_fingerprint(b).first().checksum


def test_partition_values_that_look_like_numbers_verify(spark):
    df = spark.createDataFrame([("01", 1), ("02", 2), ("02", 3)], "k string, v int")
    path = scratch_dir(spark, "by-text")
    done = write_parquet_observed(df, path, partition_by=("k",))
    assert_verified(verify_written(spark, path, done, df.schema))


def test_partitioned_write_makes_few_files(spark):
    df = spark.range(4000).repartition(16).selectExpr("id", "cast(id % 5 as string) as k")
    path = scratch_dir(spark, "few-files")
    write_parquet(df, path, partition_by=("k",))
    assert len(spark.read.parquet(path).inputFiles()) <= 10


def test_csv_keeps_edge_spaces_and_tells_malformed_rows(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from brightwash.sources import corrupt_rows, read_csv, write_csv

    path = scratch_dir(spark, "spaces")
    rows = [(" a ",), ("b\t",), ('c\n"d", e',)]
    write_csv(spark.createDataFrame(rows, "t string"), path)
    text = StructType([StructField("t", StringType())])
    assert sorted(tuple(r) for r in read_csv(spark, path, schema=text, multi_line=True).collect()) == sorted(rows)
    write_csv(spark.createDataFrame([("1",), ("x",), ("3",)], "n string"), path)
    typed = StructType([StructField("n", IntegerType())])
    got = read_csv(spark, path, schema=typed, corrupt_column="_bad")
    assert tuple(corrupt_rows(got, "_bad").first()) == (3, 1)


def test_stream_dedup_with_a_hot_row_across_batches(spark):
    import datetime as dt

    source = scratch_dir(spark, "feed-hot")
    sink = scratch_dir(spark, "sink-hot")
    ckpt = scratch_dir(spark, "ckpt-hot")
    hot = (7, dt.date(2021, 5, 1))
    everything = []
    for wave in range(3):
        rows = [hot] * 150 + [(1000 * wave + i, dt.date(2021, 5, 1 + i % 28)) for i in range(300)]
        everything += rows
        spark.createDataFrame(rows, REVIEWS).repartition(2).write.mode("append").parquet(source)
    query = start_review_dedup(review_stream(spark, source, max_files_per_trigger=2), sink, ckpt)
    query.awaitTermination()
    stored = spark.read.schema(REVIEWS).parquet(sink)
    assert sorted(tuple(r) for r in stored.collect()) == sorted(set(everything))


def test_one_file_is_written_from_a_stored_copy(spark):
    from brightwash.sources.files import dealt_to_files

    rows = [(i, None if i % 7 == 0 else f"n{i}", i % 3 / 2) for i in range(500)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "`id no` long, name string, v double").repartition(5)
    one, copy = dealt_to_files(df, 1)
    # no shuffle hands the whole table to the task that writes the file
    assert copy is not None and "Exchange" not in one._jdf.queryExecution().toString()
    assert one.rdd.getNumPartitions() == 1 and one.exceptAll(df).isEmpty() and one.count() == 501
    several, none = dealt_to_files(df, 4)
    assert none is None and several.rdd.getNumPartitions() == 4
    for frame in (df, df.limit(0)):
        for files in (1, 4):
            path = scratch_dir(spark, "files")
            write_parquet(frame, path, files=files)
            back = spark.read.schema(df.schema).parquet(path)
            assert back.count() == frame.count() and back.exceptAll(frame).isEmpty()
            if frame is df:
                assert len([f for f in os.listdir(_local(path)) if f.endswith(".parquet")]) == files
    observed = write_parquet_observed(df, scratch_dir(spark, "files"), files=1)
    assert observed["rows"] == 501
