"""Column profiles that grow with their table: one mergeable state per file.

A state holds, per file and column, the rows, the NULLs, and of the numbers the
count, the smallest, the largest, the mean, the sum of squared deviations and a
KLL sketch of the quantiles, and of all values a theta sketch of the distinct
ones. States of files add up to the state of the table, so a profile after new
files have come reads only those; a file that was changed counts as new, the
state of one that is gone is left out.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType
from pyspark.sql.utils import AnalysisException

KLL_K = 200  # rank error about 1.3 %
THETA_LG_K = 12  # 4,096 hashes: error about 1.6 %, exact below


def _versions() -> list[Column]:
    """The file of a row and its version."""
    changed = F.unix_micros("_metadata.file_modification_time")
    return [F.col("_metadata.file_path").alias("file"), F.concat_ws(":", "_metadata.file_size", changed).alias("version")]


def _column_state(df: DataFrame, name: str) -> Column:
    """Aggregates of one column, as a struct."""
    value = F.col(f"`{name}`")
    number = value.cast("double") if isinstance(df.schema[name].dataType, NumericType) else F.lit(None).cast("double")
    number = F.when(~F.isnan(number), number)
    return F.struct(
        F.lit(name).alias("column_name"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.count(number).alias("numbers"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.avg(number).alias("mean"),
        (F.var_pop(number) * F.count(number)).alias("squares"),
        F.kll_sketch_agg_double(number, KLL_K).alias("ranks"),
        F.theta_sketch_agg(value.cast("string"), THETA_LG_K).alias("values"),
    )


def file_states(df: DataFrame) -> DataFrame:
    """(file, version, position, column_name, rows, nulls, numbers, low, high,
    mean, squares, ranks, values): one aggregate over the files of ``df``, which
    must be read straight from files."""
    columns = df.columns
    states = [_column_state(df, c) for c in columns]
    rows = df.select(*_versions(), *[F.col(f"`{c}`") for c in columns]).groupBy("file", "version")
    rows = rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(states)])
    return rows.select("file", "version", F.posexplode(F.array(*[f"s{i}" for i in range(len(columns))])).alias("position", "s")).select(
        "file", "version", "position", "s.*"
    )


def table_profile(states: DataFrame, digits: int = 6) -> DataFrame:
    """(position, column_name, rows, nulls, numbers, low, high, mean, stddev,
    median, distinct_values) from the states of a table's files.

    All but the last two are exact (sums of floating numbers up to rounding);
    those are estimates of the sketches. Numeric figures are NULL for columns
    that hold no numbers.
    """
    by = ["position", "column_name"]
    sums = states.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("numbers").alias("numbers"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum(F.col("mean") * F.col("numbers")).alias("total"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
        F.theta_union_agg("values", THETA_LG_K).alias("values"),
    )
    sums = sums.withColumn("mean", F.try_divide("total", "numbers"))
    # deviations from the table's mean: those within the files and between them;
    # one row a column is broadcast
    centre = sums.select(*by, F.col("mean").alias("centre"))
    spread = states.join(F.broadcast(centre), by).groupBy(*by).agg(
        F.sum(F.col("squares") + F.col("numbers") * F.pow(F.col("mean") - F.col("centre"), F.lit(2.0))).alias("squares")
    )
    out = sums.join(F.broadcast(spread), by)
    return out.select(
        *by, "rows", "nulls", "numbers", "low", "high",
        F.round("mean", digits).alias("mean"),
        F.round(F.sqrt(F.try_divide(F.col("squares"), F.when(F.col("numbers") > 1, F.col("numbers") - 1))), digits).alias("stddev"),
        F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(0.5))).alias("median"),
        F.theta_sketch_estimate("values").alias("distinct_values"),
    )


@dataclass(frozen=True)
class Refreshed:
    """The states of a table's present files, and how many were read for it."""

    states: DataFrame
    files_read: int


def refresh_states(spark: SparkSession, table: str, root: str, schema: StructType | None = None) -> Refreshed:
    """States of the Parquet files under ``table``, those of files seen before
    taken from ``root``. Only new and changed files are read; their states are
    written to a new folder under ``root``. Paths alone come to the driver."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table).select("path", *_versions())
    try:
        known = spark.read.option("recursiveFileLookup", True).parquet(root)
    except AnalysisException as absent:
        if absent.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        known = None
    new = files if known is None else files.join(known.select("file", "version").distinct(), ["file", "version"], "left_anti")
    paths = [row.path for row in new.select("path").collect()]
    if paths:
        reader = spark.read if schema is None else spark.read.schema(schema)
        file_states(reader.parquet(*paths)).write.parquet(os.path.join(root, uuid.uuid4().hex))
    elif known is None:
        raise ValueError(f"no files under {table}")
    every = spark.read.option("recursiveFileLookup", True).parquet(root)
    # a state written twice (two sessions, a retried run) counts once
    present = every.dropDuplicates(["file", "version", "position"]).join(files.select("file", "version"), ["file", "version"], "left_semi")
    return Refreshed(present, len(paths))


def top_null_columns(states: DataFrame, k: int = 10) -> DataFrame:
    """(column_name, nulls) of the ``k`` columns with most NULLs."""
    nulls = states.groupBy("column_name").agg(F.sum("nulls").alias("nulls"))
    return nulls.orderBy(F.desc("nulls"), "column_name").limit(k)
