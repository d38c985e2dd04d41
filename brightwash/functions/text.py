"""Price text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightwash.functions.predicates import is_missing_text

# Fixed patterns: keep digits and dots only, then give a leading dot a zero.
_NOT_NUMBER = r"[^0-9.]"
_LEADING_DOT = r"^\."


def clean_price_text(c: Column) -> Column:
    """``'$1,234.50'`` -> 1234.5, ``'.75'`` -> 0.75, missing or junk -> NULL.

    Signs are dropped with every other non-digit (``'-50'`` -> 50.0) and text
    with two dots does not parse (``'1.2.3'`` -> NULL).
    """
    digits = F.regexp_replace(c, _NOT_NUMBER, "")
    with_zero = F.regexp_replace(digits, _LEADING_DOT, "0.")
    return F.when(is_missing_text(c), F.lit(None).cast("double")).otherwise(
        with_zero.try_cast("double")
    )
