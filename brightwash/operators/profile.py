"""Profiling: counts, NULLs, describe, distinct values, schema, preview.

Each function is one aggregate (one scan) however many numbers it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _sql_str(text: str) -> str:
    """A SQL string literal (quotes and backslashes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one column per input column: its NULL count (0 when empty)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """``(position, column_name, null_count)``, one row per input column.

    The wide one-row aggregate is turned into rows with ``stack`` (no second
    pass over the data).
    """
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"{i}, {_sql_str(c)}, _n{i}" for i, c in enumerate(df.columns))
    return wide.selectExpr(
        f"stack({len(df.columns)}, {pairs}) AS (position, column_name, null_count)"
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One row: ``rows`` plus ``<column>_nulls`` for every column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns],
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(dataset, rows)`` for several tables, as one union of aggregates."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_numeric(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """Typed ``describe()``: ``(column_name, count, mean, stddev, min, max)``.

    One aggregate for all columns, then ``stack`` to rows. ``min`` and
    ``max`` are returned as doubles so all columns share one type. ``digits``
    rounds mean and stddev (floating sums depend on partition order).
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        mean, std = F.avg(x), F.stddev_samp(x)
        if digits is not None:
            mean, std = F.round(mean, digits), F.round(std, digits)
        aggs += [
            F.count(x).alias(f"_c{i}"),
            mean.alias(f"_m{i}"),
            std.alias(f"_s{i}"),
            F.min(x).alias(f"_lo{i}"),
            F.max(x).alias(f"_hi{i}"),
        ]
    wide = df.agg(*aggs)
    rows = ", ".join(
        f"{_sql_str(c)}, _c{i}, _m{i}, _s{i}, _lo{i}, _hi{i}" for i, c in enumerate(columns)
    )
    return wide.selectExpr(
        f"stack({len(columns)}, {rows}) AS (column_name, count, mean, stddev, min, max)"
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (partial aggregation before the shuffle)."""
    return df.select(column).distinct()


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``(position, column_name, data_type, nullable)`` from the schema.

    Metadata only: no data is read.
    """
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def preview(df: DataFrame, columns: list[str], n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows of a projection; with ``order_by`` the choice is stable."""
    out = df.select(*columns)
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(n)
