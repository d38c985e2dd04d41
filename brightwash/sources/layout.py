"""Tables laid out so that a box in several columns reads few row groups.

Rows are ordered along a space-filling curve before the write: each column is
cut into 2**bits steps between its smallest and largest value, and the bits of
the steps are interleaved (Z-order). Rows near each other in all columns
are near each other on the curve, so each file and row group covers a
small box, and the minima and maxima that Parquet keeps let a reader pass over
the others. Range partitioning on the key evens out the files however the
values are spread, as rows, not steps, are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwash.sources.files import write_parquet

KEY_BITS = 60  # of the key, shared by the columns


def value_bounds(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float] | None]:
    """Smallest and largest finite value of each numeric column (one pass; from
    a Parquet source only these columns are read); None without any."""
    inf = float("inf")
    finite = [F.when(F.col(c).cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308) & (F.col(c) < inf), F.col(c).cast("double")) for c in columns]
    row = df.agg(*[F.min(v).alias(f"low{i}") for i, v in enumerate(finite)], *[F.max(v).alias(f"high{i}") for i, v in enumerate(finite)]).first()
    return [None if row[f"low{i}"] is None else (row[f"low{i}"], row[f"high{i}"]) for i in range(len(columns))]


def curve_key(columns: Sequence[str], bounds: Sequence[tuple[float, float] | None]) -> Column:
    """The place of a row on the Z-order curve, a long.

    Values outside the bounds count as the nearest bound, NULL and NaN as the
    lowest and highest; a column without bounds is left out.
    """
    used = [(c, b) for c, b in zip(columns, bounds) if b is not None]
    if not used:
        return F.lit(0).cast("bigint")
    bits = min(20, KEY_BITS // len(used))
    top = (1 << bits) - 1
    key = F.lit(0).cast("bigint")
    for i, (column, (low, high)) in enumerate(used):
        # halves, because the range of very large values may not fit a double
        width = high / 2 - low / 2
        share = (F.col(column).cast("double") / 2 - F.lit(low / 2)) / F.lit(width if width > 0 else 1.0)
        step = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(share, F.lit(0.0)))) * top
        step = F.when(F.isnan(F.col(column).cast("double")), F.lit(float(top))).otherwise(step).cast("bigint")
        for bit in range(bits):
            moved = F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(used) + i)
            key = key.bitwiseOR(moved)
    return key


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Snappy Parquet with the rows in the order of the curve over ``columns``.

    One shuffle: rows are range partitioned on the key and sorted in each
    partition; ``files`` is their number (default: as many as shuffle
    partitions, at least 8, and AQE does not merge them). ``df`` is read three
    times (bounds, the sample for the ranges, the write).
    """
    bounds = value_bounds(df, columns)
    count = files or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = curve_key(columns, bounds)
    ordered = df.repartitionByRange(count, key).sortWithinPartitions(key)
    write_parquet(ordered, path, max_records_per_file=max_records_per_file)
