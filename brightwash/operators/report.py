"""Before / after quality report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwash.config import TOP_NULLS_K
from brightwash.operators.profile import null_profile


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def pct_reduction(initial: Column, final: Column) -> Column:
    """``(1 - final / initial) * 100`` rounded to 2 digits, 0 of nothing."""
    return F.when(initial == 0, F.lit(0.0)).otherwise(F.round((F.lit(1.0) - final / initial) * 100, 2))


def reduction_table(datasets: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """``(dataset, initial, final, pct_reduction)`` per (name, raw, clean).

    ``pct_reduction = (1 - final / initial) * 100`` rounded to 2 digits, 0
    for an empty raw table. Each row is the raw count with the clean count as
    a scalar subquery, so no table is joined and nothing is collected.
    """
    parts = []
    for name, raw, clean in datasets:
        final = _count(clean).scalar()
        parts.append(
            _count(raw).select(
                F.lit(name).alias("dataset"),
                F.col("n").alias("initial"),
                final.alias("final"),
                pct_reduction(F.col("n"), final).alias("pct_reduction"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_nulls(raw: DataFrame, final: DataFrame, k: int = TOP_NULLS_K) -> DataFrame:
    """``(column_name, nulls_raw, nulls_final)`` for the ``k`` columns with
    most NULLs before cleaning; a column missing after cleaning counts 0.

    Both sides are one row per column (bounded by the schema width), so the
    join is between two tiny tables.
    """
    before = null_profile(raw).select("column_name", F.col("null_count").alias("nulls_raw"))
    after = null_profile(final).select("column_name", F.col("null_count").alias("nulls_final"))
    return (
        before.join(F.broadcast(after), "column_name", "left")
        .select(
            "column_name",
            "nulls_raw",
            F.coalesce(F.col("nulls_final"), F.lit(0)).cast("bigint").alias("nulls_final"),
        )
        .orderBy(F.col("nulls_raw").desc(), F.col("column_name"))
        .limit(k)
    )
