"""Deduplication and duplicate counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_500_000


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row deduplication (NULL equals NULL, NaN equals NaN, 0.0 = -0.0).

    Planned as a two-phase aggregate: every map task first collapses its own
    copies, so a row repeated in a third of the table ships as one row per
    task, not as a hot shuffle partition.
    """
    return df.dropDuplicates()


def dealt_by_row(df: DataFrame, rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distinct rows (``rows`` at most) dealt anew, ``rows_per_task`` to a partition.

    A grouping of deduplicated rows by the same columns needs no shuffle, so
    its tables would stand in the task that still holds the one of the
    deduplication. From here on they are in tasks of their own, whose size
    does not grow with the input.
    """
    return df.repartition(max(1, -(-rows // rows_per_task)), *df.columns)


def dedup_with_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Distinct rows plus the number of copies each had (one aggregate).

    Same rows as :func:`dedup_rows`; the extra column lets raw counts be
    computed after the shuffle (``sum(copies)`` = raw rows).
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def duplicate_stats(df: DataFrame) -> DataFrame:
    """One row: ``rows, distinct_rows, duplicates`` in one shuffle.

    Grouping by every column counts the copies of each distinct row; the
    totals follow from one more (tiny) aggregate. An empty table gives zeros.
    """
    groups = dedup_with_copies(df, "_copies")
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )


def dedup_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` values.

    Ties on ``order_by`` are broken by the remaining columns, so the result
    is deterministic. Implemented as ``min(struct(order, rest))`` per key:
    an aggregate with map-side combine, so a hot key is reduced in every map
    task before the shuffle (a ``row_number`` window would sort the whole
    hot key inside one task).
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    carried = order_by + rest
    if len(carried) == 1:
        # one fixed column: a plain min keeps the hash aggregate
        return df.groupBy(*keys).agg(F.min(carried[0]).alias(carried[0])).select(*df.columns)
    # a struct buffer is aggregated sort-based, still combined map-side
    packed = F.struct(*[F.col(c) for c in carried]).alias("_first")
    return (
        df.groupBy(*keys)
        .agg(F.min(packed).alias("_first"))
        .select(*keys, *[F.col("_first")[c].alias(c) for c in carried])
        .select(*df.columns)
    )
