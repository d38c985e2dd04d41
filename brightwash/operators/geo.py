"""Bounding-box validation of coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwash.config import Box
from brightwash.functions.predicates import in_box, outside_box


def filter_box(df: DataFrame, box: Box, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with both coordinates inside the inclusive box."""
    return df.filter(in_box(box, lat, lon))


def outside_rows(df: DataFrame, box: Box, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with a coordinate beyond the box."""
    return df.filter(outside_box(box, lat, lon))


def outside_sample(
    df: DataFrame,
    box: Box,
    n: int = 10,
    columns: tuple[str, ...] = ("id", "name", "neighbourhood", "latitude", "longitude"),
    order_by: str = "id",
) -> DataFrame:
    """``n`` example rows outside the box, first by ``order_by`` (top-k, no full sort)."""
    return outside_rows(df, box).select(*columns).orderBy(order_by).limit(n)


def geo_profile(df: DataFrame, box: Box, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """One row: describe() of both coordinates, out-of-box count and share.

    A single aggregate replaces the separate describe / filter-count / count
    jobs; the share is NULL on an empty table instead of a division error.
    """
    total = F.count(F.lit(1))
    out = F.count_if(outside_box(box, lat, lon))
    aggs = [total.alias("rows")]
    for name, c in (("lat", lat), ("lon", lon)):
        aggs += [
            F.count(c).alias(f"{name}_count"),
            F.avg(c).alias(f"{name}_mean"),
            F.stddev_samp(c).alias(f"{name}_stddev"),
            F.min(c).alias(f"{name}_min"),
            F.max(c).alias(f"{name}_max"),
        ]
    aggs += [
        out.alias("out_of_range"),
        F.try_divide(out * 100.0, total).alias("pct_out_of_range"),
    ]
    return df.agg(*aggs)
