"""Monthly trends with months without rows filled in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def monthly_trend(df: DataFrame, key: str, date: str, window: int = 3, digits: int = 6) -> DataFrame:
    """(key, month, rows, moving_mean, change, share_of_peak) for every month from
    a key's first to its last.

    Months without rows are in, with 0. ``moving_mean`` is over the month and
    the ``window`` - 1 before it, as far as the key reaches back; ``change`` is the
    difference to the month before (NULL in the first); ``share_of_peak`` is the
    month's part of the key's largest month so far. Rows whose key or date is
    NULL do not take part.

    The rows are counted by key and month before any window, map-side first, so
    a key with a third of all rows is a few rows more in its window, one for
    each of its months.
    """
    month = F.trunc(F.col(date).cast("date"), "month")
    counted = (
        df.filter(F.col(key).isNotNull() & month.isNotNull())
        .groupBy(F.col(key), month.alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    by_key = Window.partitionBy(key).orderBy("month")
    # each month with the gap up to the key's next one
    later = F.coalesce(F.add_months(F.lead("month").over(by_key), -1), F.col("month"))
    reach = counted.select(key, "rows", F.col("month").alias("first"), later.alias("last"))
    spread = reach.select(key, "rows", "first", F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month"))
    dense = spread.select(key, "month", F.when(F.col("month") == F.col("first"), F.col("rows")).otherwise(F.lit(0).cast("bigint")).alias("rows"))
    peak = F.max("rows").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    return dense.select(
        key,
        "month",
        "rows",
        F.round(F.avg("rows").over(by_key.rowsBetween(1 - window, 0)), digits).alias("moving_mean"),
        (F.col("rows") - F.lag("rows").over(by_key)).alias("change"),
        F.round(F.col("rows") / peak, digits).alias("share_of_peak"),
    )
