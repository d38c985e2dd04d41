"""Row predicates (filters keep SQL three-valued logic)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightwash.config import MISSING_TEXT, Box


def is_missing_text(c: Column) -> Column:
    """NULL, empty string or the literal text ``'NULL'`` (text columns only)."""
    return c.isNull() | c.isin(*MISSING_TEXT)


def all_not_null(*cols: str) -> Column:
    """Every listed column is present; unlike ``dropna`` NaN counts as present."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def in_box(box: Box, lat: str = "latitude", lon: str = "longitude") -> Column:
    """Both coordinates inside the inclusive box."""
    return F.col(lat).between(box.min_lat, box.max_lat) & F.col(lon).between(
        box.min_lon, box.max_lon
    )


def outside_box(box: Box, lat: str = "latitude", lon: str = "longitude") -> Column:
    """Any coordinate beyond a bound (NULL coordinates are not counted)."""
    la, lo = F.col(lat), F.col(lon)
    return (
        (la < box.min_lat) | (la > box.max_lat) | (lo < box.min_lon) | (lo > box.max_lon)
    )


def null_or_between(c: Column, low, high) -> Column:
    """Keep NULLs, otherwise require ``low <= c <= high`` (bounds may be columns)."""
    return c.isNull() | ((c >= low) & (c <= high))
