"""Price normalisation: text cleaning, percentile trim and median fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from brightwash.functions.predicates import null_or_between
from brightwash.functions.text import clean_price_text


def price_value(df: DataFrame, src: str = "price") -> Column:
    """The price of ``df`` as a double expression.

    Text goes through the price rule; a column that is already numeric is
    only cast (rendering a double as text could give ``1.0E7``, which the
    rule would misread).
    """
    if isinstance(df.schema[src].dataType, StringType):
        return clean_price_text(F.col(src))
    return F.col(src).try_cast("double")


def add_clean_price(df: DataFrame, src: str = "price", dst: str = "price_clean") -> DataFrame:
    """Append the parsed price as a double column.

    Parsed once a row: a filter on a plain column would have the parsing copied
    into it (and moved below joins) for every mention of the column; none is
    moved below the generator of one value.
    """
    return df.withColumn(dst, F.explode(F.array(price_value(df, src))))


def trim_to_range(df: DataFrame, low: Column, high: Column, col: str = "price_clean") -> DataFrame:
    """Keep rows whose value is within ``[low, high]``; NULL values stay."""
    return df.filter(null_or_between(F.col(col), low, high))


def fill_price(
    df: DataFrame,
    fill: Column,
    src: str = "price",
    clean: str = "price_clean",
) -> DataFrame:
    """Replace the raw text column by the cleaned one, NULLs filled.

    The result has the cleaned price as the last column, named ``src``.
    """
    others = [c for c in df.columns if c not in (src, clean)]
    return df.select(*others, F.coalesce(F.col(clean), fill).alias(src))


def price_text_profile(df: DataFrame, src: str = "price", clean: str = "price_clean") -> DataFrame:
    """One row: rows, NULL prices, prices present, prices that failed to parse."""
    raw = F.col(src)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(raw.isNull()).alias("null_prices"),
        F.count_if(raw.isNotNull()).alias("valid_prices"),
        F.count_if(raw.isNotNull() & F.col(clean).isNull()).alias("unparsed_prices"),
    )
