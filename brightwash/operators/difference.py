"""Where two tables differ: checksums by key range, opened only where unequal.

Both tables are summed up by ranges of a numeric key: rows and an
order-independent checksum per range, in one scan each. Equal ranges are done.
Unequal ones are cut into ``FAN_OUT`` finer ranges and summed up again, reading
only those ranges (the key bounds reach the scan, so on a table laid out by
its key the other row groups are skipped), until a range is small; the rows of
the small unequal ranges are compared. Equal tables cost the one scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_OUT = 256
LEAF_ROWS = 20_000  # rows of a range that is compared row by row
MAX_OPEN = 256  # unequal ranges opened at once; if more are unequal, all of them are compared


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` to ``high``, both included."""

    low: int
    high: int

    def holds(self, key: Column) -> Column:
        return key.between(self.low, self.high)


def _row_hash(df: DataFrame) -> Column:
    """Hash of all columns and of which of them are NULL."""
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    return F.xxhash64(*cols, *[c.isNull() for c in cols]).cast("decimal(38,0)")


def _within(key: Column, ranges: list[Range]) -> Column:
    """A condition that holds for all keys in ``ranges`` (and perhaps some between)."""
    return reduce(lambda a, b: a | b, [r.holds(key) for r in _cover(ranges, 64)], F.lit(False))


def _sums(df: DataFrame, key: str, ranges: list[Range], step: int) -> DataFrame:
    """(part, rows, checksum) of each step-wide part of ``ranges``. Part numbers
    count from the smallest key; the NULL key is part -1."""
    start = ranges[0].low
    part = F.when(F.col(key).isNull(), F.lit(-1).cast("decimal(38,0)")).otherwise(
        F.floor((F.col(key).cast("decimal(38,0)") - F.lit(start).cast("decimal(38,0)")) / F.lit(step).cast("decimal(38,0)")).cast("decimal(38,0)")
    )
    return df.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.sum(_row_hash(df)).alias("checksum"))


def _unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """(part, rows): parts whose rows or checksums differ, with the larger count."""
    named = [t.select("part", F.col("rows").alias(f"rows_{s}"), F.col("checksum").alias(f"sum_{s}")) for t, s in ((left, "l"), (right, "r"))]
    both = named[0].join(named[1], "part", "full")
    same = F.col("rows_l").eqNullSafe(F.col("rows_r")) & F.col("sum_l").eqNullSafe(F.col("sum_r"))
    rows = F.greatest(F.coalesce("rows_l", F.lit(0)), F.coalesce("rows_r", F.lit(0)))
    return both.filter(~same).select("part", rows.alias("rows"))


def unequal_ranges(left: DataFrame, right: DataFrame, key: str, leaf_rows: int = LEAF_ROWS) -> tuple[list[Range], bool]:
    """Small key ranges that hold every difference, and whether NULL keys differ.

    Each level returns at most one small row per unequal part to the driver,
    at most ``FAN_OUT`` for each range opened.
    """
    ends = [t.agg(F.min(key).alias("low"), F.max(key).alias("high")) for t in (left, right)]
    ends = ends[0].unionByName(ends[1]).agg(F.min("low"), F.max("high")).first()
    low, high = (0, 0) if ends[0] is None else (int(ends[0]), int(ends[1]))
    small: list[Range] = []
    nulls = False
    opened, step, first = [Range(low, high)], 1, True
    while step * FAN_OUT < high - low + 1:
        step *= FAN_OUT
    while opened:
        parts = [t if first else t.filter(_within(F.col(key), opened)) for t in (left, right)]
        found = _unequal(*(_sums(t, key, opened, step) for t in parts)).collect()
        start, again = opened[0].low, []
        for row in sorted(found, key=lambda r: r["part"]):
            if row["part"] < 0:
                nulls = True
                continue
            begin = start + int(row["part"]) * step
            part = Range(begin, min(begin + step - 1, high))
            (again if row["rows"] > leaf_rows and step > 1 else small).append(part)
        if len(again) > MAX_OPEN:
            return small + again, nulls
        opened, step, first = again, step // FAN_OUT, False
    return small, nulls


def _cover(ranges: list[Range], at_most: int) -> list[Range]:
    """At most that many ranges that hold all of ``ranges``: the widest gaps stay."""
    ranges = sorted(ranges, key=lambda r: r.low)
    gaps = [(b.low - a.high, i) for i, (a, b) in enumerate(zip(ranges, ranges[1:]), 1) if b.low > a.high + 1]
    cuts = [0, *sorted(i for _, i in sorted(gaps, reverse=True)[: at_most - 1]), len(ranges)]
    return [Range(ranges[i].low, ranges[j - 1].high) for i, j in zip(cuts, cuts[1:]) if i < j]


def table_differences(left: DataFrame, right: DataFrame, key: str, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(key, change, rows_left, rows_right, columns) of every key whose rows
    differ between two tables of the same columns.

    ``change`` is ``removed`` (only left), ``added`` (only right) or ``changed``;
    ``columns`` names the differing columns where the key has one row on either
    side, in table order, else it is NULL. A key may occur several times (its
    rows then count as a multiset) or be NULL. Equal tables give no rows.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("both tables need the same columns")
    ranges, nulls = unequal_ranges(left, right, key, leaf_rows)
    where = _within(F.col(key), ranges)
    where = where | F.col(key).isNull() if nulls else where & F.col(key).isNotNull()
    others = [c for c in left.columns if c != key]

    def side(df: DataFrame, name: str) -> DataFrame:
        """One row per key: its rows' number, checksum and a sample row."""
        row = F.struct(*[F.col(f"`{c}`") for c in others])
        return df.filter(where).groupBy(F.col(key).alias("key")).agg(
            F.count("*").alias(f"rows_{name}"), F.sum(_row_hash(df)).alias(f"sum_{name}"), F.first(row).alias(f"row_{name}")
        )

    a, b = side(left, "left"), side(right, "right")
    both = a.join(b, a["key"].eqNullSafe(b["key"]), "full").select(F.coalesce(a["key"], b["key"]).alias("key"), *[c for c in a.columns + b.columns if c != "key"])
    n_left, n_right = (F.coalesce(f"rows_{s}", F.lit(0)) for s in ("left", "right"))
    same = (n_left == n_right) & F.col("sum_left").eqNullSafe(F.col("sum_right"))
    differing = [F.when(~F.col(f"row_left.`{c}`").eqNullSafe(F.col(f"row_right.`{c}`")), F.lit(c)) for c in others]
    named = F.concat_ws(",", *differing) if others else F.lit("")
    return both.filter(~same).select(
        F.col("key").alias(key),
        F.when(n_right == 0, "removed").when(n_left == 0, "added").otherwise("changed").alias("change"),
        n_left.alias("rows_left"),
        n_right.alias("rows_right"),
        F.when((n_left == 1) & (n_right == 1), named).alias("columns"),
    )
