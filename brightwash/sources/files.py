"""CSV and Parquet input / output and write verification."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brightwash.session import scratch_dir


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multi_line: bool = False,
    null_value: str | None = None,
    corrupt_column: str | None = None,
    header: bool = True,
) -> DataFrame:
    """CSV, with a header row unless ``header`` is off.

    With a ``schema`` there is no inference pass. ``escape='"'`` reads the
    doubled quotes of RFC 4180 files. ``multi_line`` keeps quoted line
    breaks inside one record, but makes every file a single task (the file
    cannot be split), so turn it on only for tables with free text and keep
    such tables in many files. By default an empty field reads as NULL; with
    a ``null_value`` marker (e.g. ``\\N``) only the marker is NULL and a quoted
    empty field stays an empty string. With a ``schema`` and a
    ``corrupt_column`` the text of a row that does not fit the schema is kept
    in that column (see :func:`corrupt_rows`); without one its unreadable
    fields are NULL.
    """
    reader = (
        spark.read.option("header", header)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if corrupt_column and schema is not None:
        schema = StructType([*schema, StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        # a reader that skips fields does not see how many a row has
        reader = reader.option("columnPruning", False)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def corrupt_rows(df: DataFrame, corrupt_column: str) -> DataFrame:
    """One row: rows read, and rows of them that did not fit the schema."""
    # the hash of all columns makes the reader parse every field; both signs
    # are counted, because a plain count would not need the hash
    parsed = df.select(F.xxhash64(*[c for c in df.columns if c != corrupt_column]).alias("h"), corrupt_column)
    return parsed.agg(
        (F.count_if(F.col("h") < 0) + F.count_if(F.col("h") >= 0)).alias("rows"),
        F.count_if(F.col(corrupt_column).isNotNull()).alias("corrupt_rows"),
    )


def write_csv(
    df: DataFrame, path: str, files: int | None = None, null_value: str | None = None
) -> None:
    """CSV with header and RFC 4180 quoting (quotes doubled).

    ``null_value`` writes NULL as a marker so it stays distinct from an
    empty string when read back with the same marker.
    """
    out = df.repartition(files) if files else df
    writer = (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        # the writer would otherwise trim the values
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dealt_to_files(df: DataFrame, files: int) -> tuple[DataFrame, str | None]:
    """The rows in ``files`` partitions, and the folder of a stored copy of them
    (None if there is none), to be emptied once they are written.

    Several files are dealt out by a shuffle. The one task that writes a single
    file reads the rows from a stored copy instead, which the upstream tasks
    write side by side: columnar and compressed, it is several times smaller
    than the same rows in a shuffle.
    """
    if files != 1:
        return df.repartition(files), None
    path = scratch_dir(df.sparkSession, "one-file")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).coalesce(1), path


def _empty(spark: SparkSession, path: str | None, schema: StructType) -> None:
    """Drop the data files of a stored copy (the public API has no delete)."""
    if path is not None:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    partition_by: tuple[str, ...] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Snappy Parquet, overwriting ``path``.

    By default the upstream stage keeps its parallelism (one file per task).
    ``files`` asks for an exact file count through :func:`dealt_to_files`, so
    the expensive upstream work stays parallel (a plain ``coalesce(1)`` would
    pull it all into one task). ``partition_by`` writes Hive-style folders so later
    filters on those columns prune whole folders. ``max_records_per_file``
    caps file size without a shuffle.
    """
    copy = None
    if files:
        out, copy = dealt_to_files(df, files)
    elif partition_by:
        # rows of a partition value meet before the write, so that a task does
        # not open a file for every value; AQE splits values that are large
        out = df.hint("rebalance", *partition_by)
    else:
        out = df
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _empty(df.sparkSession, copy, df.schema)


def _fingerprint_columns(df: DataFrame) -> list:
    """Row count and an order-independent checksum of all columns.

    ``sum`` of a 64-bit row hash (widened to decimal so it cannot overflow)
    differs when a row is lost, added or changed, and unlike ``bit_xor`` it
    does not cancel duplicate rows. The hash skips NULLs, so it also takes in
    which columns are NULL.
    """
    flags = [F.col(c).isNull() for c in df.columns]
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns], *flags).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(38,0)")).alias("checksum"),
    ]


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``checksum`` of the table (one aggregate)."""
    return df.agg(*_fingerprint_columns(df))


def write_parquet_observed(
    df: DataFrame,
    path: str,
    files: int | None = None,
    partition_by: tuple[str, ...] = (),
    max_records_per_file: int | None = None,
    extra: list | None = None,
) -> dict:
    """:func:`write_parquet` that also returns the fingerprint of what it wrote.

    The fingerprint (and any ``extra`` aggregate columns, e.g. NULL counts)
    is an ``Observation`` attached to the write job itself, so the (possibly
    expensive) upstream plan runs once, not twice.
    """
    obs = Observation(f"written-{uuid.uuid4().hex[:8]}")
    metrics = _fingerprint_columns(df) + list(extra or [])
    # The counter goes above any repartition, into the stage that writes:
    # there each task's update is applied once even if tasks are retried.
    out, copy = dealt_to_files(df, files) if files else (df, None)
    write_parquet(out.observe(obs, *metrics), path, None, partition_by, max_records_per_file)
    _empty(df.sparkSession, copy, df.schema)
    return dict(obs.get)


def _read_back(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``. Folder names hold partition values as text, which
    a reader would guess types for ("01" would become 1): those columns get the
    types of ``schema``; the files' own columns keep the types they have."""
    found = spark.read.parquet(path)
    one = found.select(F.input_file_name()).first()
    folders = {part.partition("=")[0] for part in one[0].split("/") if "=" in part} if one else set()
    told = {f.name: f for f in schema if f.name in folders}
    if not told:
        return found
    return spark.read.schema(StructType([told.get(f.name, f) for f in found.schema])).parquet(path)


def verify_written(
    spark: SparkSession,
    path: str,
    expected: dict,
    schema: StructType,
    content: bool = True,
) -> DataFrame:
    """Read ``path`` back and compare rows, schema and checksum.

    ``expected`` is the fingerprint of the source (from
    :func:`write_parquet_observed` or :func:`table_fingerprint`). Returns one
    row (``rows_expected, rows_read, columns, schema_ok, content_ok``);
    :func:`assert_verified` turns a mismatch into an error. Partition columns
    come back last, so the read-back is compared in the source column order.
    ``content=False`` checks schema and row count only: the count needs no
    column data (Parquet row-group metadata), the checksum reads everything.
    """
    written = _read_back(spark, path, schema)
    names = [f.name for f in schema]
    have = {f.name: f.dataType for f in written.schema}
    schema_ok = set(have) == set(names) and all(have[f.name] == f.dataType for f in schema)
    if content and schema_ok:
        got = table_fingerprint(written.select(*names)).first()
        rows_read, content_ok = int(got["rows"]), got["checksum"] == expected["checksum"]
    else:
        rows_read = written.count()
        content_ok = schema_ok and not content
    return spark.createDataFrame(
        [(int(expected["rows"]), rows_read, len(written.columns), schema_ok, content_ok)],
        "rows_expected long, rows_read long, columns int, schema_ok boolean, content_ok boolean",
    )


def assert_verified(result: DataFrame) -> None:
    """Raise unless schema, row count and (when checked) content agree."""
    row = result.first()
    if not (row["schema_ok"] and row["content_ok"] and row["rows_expected"] == row["rows_read"]):
        raise AssertionError(f"written table differs from its source: {row.asDict()}")
