"""Value bands (multi-branch CASE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightwash.config import PRICE_BAND_LABELS, PRICE_BAND_LIMITS


def price_band(
    c: Column,
    limits: tuple = PRICE_BAND_LIMITS,
    labels: tuple = PRICE_BAND_LABELS,
) -> Column:
    """First band whose exclusive upper limit exceeds the value; NULL falls
    into the last band, like ``CASE ... ELSE``."""
    if len(labels) != len(limits) + 1:
        raise ValueError("need one label more than limits")
    expr = None
    for limit, label in zip(limits, labels):
        expr = F.when(c < limit, label) if expr is None else expr.when(c < limit, label)
    return expr.otherwise(labels[-1])
