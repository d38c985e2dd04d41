"""Column expressions: all native Spark functions, no UDFs."""

from brightwash.functions.bands import price_band
from brightwash.functions.casts import convert_column, text_to_integral
from brightwash.functions.predicates import (
    all_not_null,
    in_box,
    is_missing_text,
    null_or_between,
    outside_box,
)
from brightwash.functions.text import clean_price_text

__all__ = [
    "all_not_null",
    "clean_price_text",
    "convert_column",
    "in_box",
    "is_missing_text",
    "null_or_between",
    "outside_box",
    "price_band",
    "text_to_integral",
]
