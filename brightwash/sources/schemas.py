"""Explicit schemas of the three tables (raw text as read from CSV, and clean).

Reading with a schema avoids the extra pass that ``inferSchema`` spends on
the input and gives every file the same types.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

LISTING_COLUMNS = (
    "id",
    "name",
    "host_id",
    "host_name",
    "neighbourhood_group",
    "neighbourhood",
    "latitude",
    "longitude",
    "room_type",
    "price",
    "minimum_nights",
    "number_of_reviews",
    "last_review",
    "reviews_per_month",
    "calculated_host_listings_count",
    "availability_365",
    "number_of_reviews_ltm",
    "license",
)

# Raw listings: every column as text, the way a CSV holds it.
LISTINGS_RAW = StructType([StructField(c, StringType(), True) for c in LISTING_COLUMNS])

_CLEAN_TYPES = {
    "id": LongType(),
    "host_id": LongType(),
    "latitude": DoubleType(),
    "longitude": DoubleType(),
    "minimum_nights": IntegerType(),
    "number_of_reviews": IntegerType(),
    "last_review": DateType(),
    "reviews_per_month": DoubleType(),
    "calculated_host_listings_count": IntegerType(),
    "availability_365": IntegerType(),
    "number_of_reviews_ltm": IntegerType(),
}

# Clean listings: typed, ``price`` moved last as a double.
LISTINGS_CLEAN = StructType(
    [
        StructField(c, _CLEAN_TYPES.get(c, StringType()), True)
        for c in LISTING_COLUMNS
        if c != "price"
    ]
    + [StructField("price", DoubleType(), True)]
)

NEIGHBOURHOODS = StructType(
    [
        StructField("neighbourhood_group", StringType(), True),
        StructField("neighbourhood", StringType(), True),
    ]
)

REVIEWS = StructType(
    [
        StructField("listing_id", LongType(), True),
        StructField("date", DateType(), True),
    ]
)

SCHEMAS = {
    "listings": LISTINGS_RAW,
    "listings_clean": LISTINGS_CLEAN,
    "neighbourhoods": NEIGHBOURHOODS,
    "reviews": REVIEWS,
}
