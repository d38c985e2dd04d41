"""ANSI-safe type conversion.

Under ANSI mode a plain ``cast`` of bad text raises; the conversions here
use ``try_cast`` so unparseable or out-of-range values become NULL, never an
error and never a wrapped number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType

from brightwash.functions.predicates import is_missing_text


def _as_type(target: DataType | str) -> DataType:
    return DataType.fromDDL(target) if isinstance(target, str) else target


def text_to_integral(c: Column, target: DataType | str = "bigint") -> Column:
    """Text to an integral type; decimals truncate toward zero.

    ``'12'`` -> 12, ``'3.7'`` -> 3, ``'-3.7'`` -> -3, junk or overflow -> NULL.
    """
    as_long = F.coalesce(
        c.try_cast("bigint"),
        c.try_cast("decimal(38,10)").try_cast("bigint"),
    )
    return as_long.try_cast(_as_type(target))


def convert_column(c: Column, source: DataType, target: DataType | str) -> Column:
    """Convert one column to ``target``.

    Text treats NULL, ``''`` and ``'NULL'`` as missing; integral targets use
    the truncation rule of :func:`text_to_integral`. Numeric sources are
    converted with ``try_cast`` (overflow -> NULL). The sentinel comparison is
    only applied to text, so numeric columns never go through a string cast.
    """
    target = _as_type(target)
    if isinstance(source, StringType):
        if isinstance(target, IntegralType):
            parsed = text_to_integral(c, target)
        elif isinstance(target, DateType):
            parsed = F.try_to_date(c, "yyyy-MM-dd")
        else:
            parsed = c.try_cast(target)
        return F.when(is_missing_text(c), F.lit(None).cast(target)).otherwise(parsed)
    if source == target:
        return c
    return c.try_cast(target)
