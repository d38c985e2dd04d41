"""Joins against dimension tables with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwash.session import scratch_dir

# A side is broadcast only when it is proven to hold at most this many rows.
DEFAULT_BROADCAST_ROWS = 100_000
# ... and bytes.
DEFAULT_BROADCAST_BYTES = 32 << 20


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """Bounded row check without reading a large side.

    ``limit(n + 1).collect()`` runs incrementally: it scans one partition,
    then a growing number, and stops as soon as ``n + 1`` rows are found, so
    a big table costs a few partitions. Only a constant column is kept, so at
    most ``n + 1`` one-field rows reach the driver.
    """
    return len(df.select(F.lit(1).alias("one")).limit(max_rows + 1).collect()) <= max_rows


def bytes_at_most(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether ``df`` is proven small: at most that many rows, and of those at
    most that many bytes of values (text and binary by their length, any other
    value as 16). Reads no more than ``max_rows`` + 1 rows."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(16) for c, kind in df.dtypes
    ]
    head = df.select(sum(widths, F.lit(0)).cast("long").alias("width")).limit(max_rows + 1)
    seen = head.agg(F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    return seen[0] <= max_rows and seen[1] <= max_bytes


def anti_join_keys(facts: DataFrame, dimension: DataFrame, key: str, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``facts`` whose ``key`` is in no row of a large ``dimension``; a
    NULL key is in none.

    Both sides are first reduced to their distinct keys, map-side, so a key with
    a third of all rows is one row of the shuffled anti join. The keys found
    missing, usually few, then pick the rows: broadcast if they are proven
    small, else in a second shuffle.
    """
    known = dimension.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    missing = facts.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().join(known.hint("shuffle_hash"), key, "left_anti")
    path = scratch_dir(facts.sparkSession, "missing-keys")
    missing.write.parquet(path)  # found once, used by the check and by the join
    missing = facts.sparkSession.read.schema(missing.schema).parquet(path)
    picked = F.broadcast(missing) if bytes_at_most(missing, max_rows, max_bytes) else missing
    return facts.join(picked, key, "left_semi").unionByName(facts.filter(F.col(key).isNull()))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` to a dimension; broadcast it only behind a size check.

    Beyond ``max_rows`` or ``max_bytes`` the plan falls back to a shuffle join, which AQE can
    still turn into a broadcast at runtime or split when a key is skewed.
    """
    side = F.broadcast(dim) if bytes_at_most(dim, max_rows, max_bytes) else dim
    return fact.join(side, on, how)
