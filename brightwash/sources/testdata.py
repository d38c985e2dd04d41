"""Dirty listing-style tables derived from the driver's TPC-H-like tables.

The driver tables hold no NULLs and no duplicate rows, so the dirt the
cleaning flow has to handle is produced here by integer formulas on the
keys. The same formulas are written in SQL for the independent oracle, so
both engines start from identical rows.

listings      = orders JOIN customer JOIN nation JOIN region
neighbourhoods = nation JOIN region, the group NULL for some regions (or, for
                queries on the dimension alone, as seen in the listings)
reviews       = lineitem projected to (listing_id, date), which carries
                natural full-row duplicates, with NULLs in either column
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



# Schemas of the driver tables that are read; an explicit schema skips the
# footer-reading job that schema inference would start for every read.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """18 listing columns with NULLs, sentinels and junk text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # orders x customer is fact x fact-sized: a shuffle join, which AQE
    # turns into a broadcast at runtime only when the measured side is small
    # and splits when one customer holds a large share of the orders.
    # nation (25 rows) and region (5 rows) are fixed-size; the planner
    # broadcasts them from their file-size statistics.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    hosts = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    joined = orders.join(hosts, orders.o_custkey == hosts.c_custkey)

    k, c = F.col("o_orderkey"), F.col("c_custkey")
    amount = F.floor(F.col("o_totalprice") / 3).cast("bigint")
    # some with a thousands comma
    whole = F.when(
        (k % 11 == 1) & (amount >= 1000),
        F.concat((amount / 1000).cast("bigint").cast("string"), F.lit(","), F.lpad((amount % 1000).cast("string"), 3, "0")),
    ).otherwise(amount.cast("string"))
    price = (
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 101 == 0, F.lit("NULL"))
        .when(k % 103 == 0, F.lit(""))
        .when(k % 107 == 0, F.lit("n/a"))
        .when(k % 109 == 0, F.lit(".75"))
        .when(k % 151 == 0, F.lit("1.2.3"))
        .otherwise(
            F.concat(F.when(k % 13 == 1, "-").otherwise(""), F.lit("$"), whole, F.lit(".50"))
        )
    )
    name = F.concat(F.lit("Order "), k.cast("string"))
    name = (
        F.when(k % 113 == 0, F.lit(None))
        .when(k % 127 == 0, F.concat(name, F.lit(',\n"the second line"')))
        .when(k % 131 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
        .otherwise(name)
    )
    neighbourhood = (
        F.when(k % 139 == 0, F.lit(None))
        .when(k % 149 == 0, F.concat(F.lit("Unlisted "), F.col("n_name")))
        .otherwise(F.col("n_name"))
    )
    minimum_nights = (
        F.when(k % 61 == 0, F.lit(""))
        .when(k % 67 == 0, F.lit("3.7"))
        .when(k % 71 == 0, F.lit("x"))
        .otherwise((k % 30).cast("string"))
    )
    return joined.select(
        k.alias("id"),
        name.alias("name"),
        c.alias("host_id"),
        _null_when(k % 97 == 0, F.col("c_name")).alias("host_name"),
        _null_when(F.col("n_regionkey") == 0, F.col("r_name")).alias("neighbourhood_group"),
        neighbourhood.alias("neighbourhood"),
        _null_when(k % 89 == 0, F.lit(-33.9) + (k % 1000) / F.lit(1000.0)).alias("latitude"),
        _null_when(k % 83 == 0, F.lit(-71.0) + (c % 1000) / F.lit(1000.0)).alias("longitude"),
        _null_when(k % 137 == 0, F.col("o_orderpriority")).alias("room_type"),
        price.alias("price"),
        minimum_nights.alias("minimum_nights"),
        (k % 200).alias("number_of_reviews"),
        _null_when(k % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_review"),
        _null_when(k % 5 == 0, (k % 50) / F.lit(10.0)).alias("reviews_per_month"),
        (F.lit(1) + c % 25).alias("calculated_host_listings_count"),
        _null_when(k % 59 == 0, k % 366).alias("availability_365"),
        (k % 13).alias("number_of_reviews_ltm"),
        _null_when(k % 50 != 0, F.concat(F.lit("LIC-"), k.cast("string"))).alias("license"),
    )


def neighbourhoods_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a neighbourhood dimension; the group is NULL for region 0."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        _null_when(F.col("n_regionkey") == 0, F.col("r_name")).alias("neighbourhood_group"),
        F.col("n_name").alias("neighbourhood"),
    )


def neighbourhoods_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbourhood dimension as it appears in the listings: one row per
    distinct group and neighbourhood, either of which may be NULL."""
    return listings_raw(spark, sf_dir).select("neighbourhood_group", "neighbourhood").distinct()


def line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 64-bit key per line item, above 2**53."""
    order = F.pmod(F.col("l_orderkey"), F.lit(1_000_000))
    return table(spark, sf_dir, "lineitem").select(
        (order * 1_000_000_000_000 + F.col("l_partkey") + F.lit(2**53)).alias("line_key")
    )


def reviews_raw(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    """(listing_id, date) per line item; ``with_order`` adds the order key."""
    cols = [
        _null_when(F.col("l_orderkey") % 163 == 0, F.col("l_partkey")).alias("listing_id"),
        _null_when(F.col("l_orderkey") % 157 == 0, F.col("l_shipdate").cast("date")).alias("date"),
    ]
    if with_order:
        cols.append(F.col("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select(*cols)


def listings_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listings as CSV records (column ``value``, NULL as ``\\N``). Some
    have a field too many, some end after the first."""
    raw = listings_raw(spark, sf_dir)
    options = {"escape": '"', "nullValue": r"\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*[F.col(c).cast("string") for c in raw.columns]), options)
    k = F.col("id")
    broken = F.when(k % 173 == 0, F.concat(line, F.lit(",one more"))).when(k % 179 == 0, k.cast("string"))
    return raw.select(F.coalesce(broken, line).alias("value"))


def orders_changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of a table of orders: in the second some rows are gone, some
    are new, some occur twice, and some differ in one column or two."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    after = orders.filter(k % 1009 != 0).withColumns(
        {
            "o_totalprice": F.when(k % 1013 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderstatus": _null_when((k % 1019 == 0) | (k % 2026 == 0), F.col("o_orderstatus")),
        }
    )
    new = orders.filter(k % 1021 == 0).withColumn("o_orderkey", -k)
    return orders, after.unionByName(new).unionByName(after.filter(k % 1031 == 0))
