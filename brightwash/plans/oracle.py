"""Independent SQL (DuckDB dialect) for every registered query.

The correctness check runs each registered Spark query and the SQL here on
the same Parquet tables and compares rows. The SQL is written from the
definitions, not generated from the Spark plans. Conventions: double
literals as ``1e0`` forms, ``regexp_replace(..., 'g')`` for all matches,
exact discrete quantiles, rounded floating means.
"""

from __future__ import annotations

from brightwash.config import (
    DESCRIBE_COLUMNS,
    REVIEW_STATS_K,
    REVIEW_STATS_MIN_COUNT,
    TOP_EXPENSIVE_K,
    TOP_EXPENSIVE_MIN_COUNT,
)
from brightwash.plans.oracle_storage import storage_queries

RAW = r"""
raw AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_orderkey % 113 = 0 THEN NULL
              WHEN o.o_orderkey % 127 = 0 THEN 'Order ' || CAST(o.o_orderkey AS VARCHAR) || ',' || chr(10) || '"the second line"'
              WHEN o.o_orderkey % 131 = 0 THEN '  Order ' || CAST(o.o_orderkey AS VARCHAR) || ' '
              ELSE 'Order ' || CAST(o.o_orderkey AS VARCHAR) END AS name,
         c.c_custkey AS host_id,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE c.c_name END AS host_name,
         CASE WHEN n.n_regionkey = 0 THEN NULL ELSE r.r_name END AS neighbourhood_group,
         CASE WHEN o.o_orderkey % 139 = 0 THEN NULL
              WHEN o.o_orderkey % 149 = 0 THEN 'Unlisted ' || n.n_name
              ELSE n.n_name END AS neighbourhood,
         CASE WHEN o.o_orderkey % 89 = 0 THEN NULL ELSE -33.9e0 + (o.o_orderkey % 1000) / 1000e0 END AS latitude,
         CASE WHEN o.o_orderkey % 83 = 0 THEN NULL ELSE -71.0e0 + (c.c_custkey % 1000) / 1000e0 END AS longitude,
         CASE WHEN o.o_orderkey % 137 = 0 THEN NULL ELSE o.o_orderpriority END AS room_type,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
              WHEN o.o_orderkey % 101 = 0 THEN 'NULL'
              WHEN o.o_orderkey % 103 = 0 THEN ''
              WHEN o.o_orderkey % 107 = 0 THEN 'n/a'
              WHEN o.o_orderkey % 109 = 0 THEN '.75'
              WHEN o.o_orderkey % 151 = 0 THEN '1.2.3'
              ELSE (CASE WHEN o.o_orderkey % 13 = 1 THEN '-$' ELSE '$' END)
                   || (CASE WHEN o.o_orderkey % 11 = 1 AND FLOOR(o.o_totalprice / 3) >= 1000
                            THEN CAST(CAST(FLOOR(o.o_totalprice / 3) AS BIGINT) // 1000 AS VARCHAR) || ','
                                 || lpad(CAST(CAST(FLOOR(o.o_totalprice / 3) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
                            ELSE CAST(CAST(FLOOR(o.o_totalprice / 3) AS BIGINT) AS VARCHAR) END)
                   || '.50' END AS price,
         CASE WHEN o.o_orderkey % 61 = 0 THEN ''
              WHEN o.o_orderkey % 67 = 0 THEN '3.7'
              WHEN o.o_orderkey % 71 = 0 THEN 'x'
              ELSE CAST(o.o_orderkey % 30 AS VARCHAR) END AS minimum_nights,
         o.o_orderkey % 200 AS number_of_reviews,
         CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS last_review,
         CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE (o.o_orderkey % 50) / 10e0 END AS reviews_per_month,
         1 + c.c_custkey % 25 AS calculated_host_listings_count,
         CASE WHEN o.o_orderkey % 59 = 0 THEN NULL ELSE o.o_orderkey % 366 END AS availability_365,
         o.o_orderkey % 13 AS number_of_reviews_ltm,
         CASE WHEN o.o_orderkey % 50 = 0 THEN 'LIC-' || CAST(o.o_orderkey AS VARCHAR) ELSE NULL END AS license
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

TYPED = r"""
typed AS (
  SELECT id, name, host_id, host_name, neighbourhood_group, neighbourhood,
         latitude, longitude, room_type, price,
         CASE WHEN minimum_nights IS NULL OR minimum_nights IN ('', 'NULL') THEN NULL
              ELSE TRY_CAST(TRUNC(TRY_CAST(minimum_nights AS DECIMAL(38,10))) AS INTEGER) END AS minimum_nights,
         TRY_CAST(number_of_reviews AS INTEGER) AS number_of_reviews,
         CASE WHEN last_review IS NULL OR last_review IN ('', 'NULL') THEN NULL
              ELSE TRY_CAST(last_review AS DATE) END AS last_review,
         reviews_per_month,
         TRY_CAST(calculated_host_listings_count AS INTEGER) AS calculated_host_listings_count,
         TRY_CAST(availability_365 AS INTEGER) AS availability_365,
         TRY_CAST(number_of_reviews_ltm AS INTEGER) AS number_of_reviews_ltm,
         license
  FROM raw
)"""

FILLED = r"""
filled AS (
  SELECT id,
         COALESCE(name, 'Propiedad_Sin_Nombre') AS name,
         host_id,
         COALESCE(host_name, 'Host_Desconocido') AS host_name,
         COALESCE(neighbourhood_group, 'Sin_Grupo') AS neighbourhood_group,
         neighbourhood, latitude, longitude, room_type, price,
         CAST(COALESCE(minimum_nights, 1) AS INTEGER) AS minimum_nights,
         number_of_reviews, last_review,
         COALESCE(reviews_per_month, 0e0) AS reviews_per_month,
         calculated_host_listings_count, availability_365, number_of_reviews_ltm, license
  FROM typed
)"""

LOCATED = r"""
located AS (SELECT * FROM filled WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""

BOXED = r"""
boxed AS (
  SELECT * FROM located
  WHERE latitude BETWEEN -33.8e0 AND -33.0e0 AND longitude BETWEEN -70.9e0 AND -70.2e0
)"""

PRICED = r"""
priced AS (
  SELECT *,
         CASE WHEN price IS NULL OR price IN ('', 'NULL') THEN NULL
              ELSE TRY_CAST(regexp_replace(regexp_replace(price, '[^0-9.]', '', 'g'), '^\.', '0.') AS DOUBLE)
         END AS price_clean
  FROM boxed
)"""

QS = r"""
qs AS (
  SELECT quantile_disc(price_clean, 0.01) AS p1,
         quantile_disc(price_clean, 0.05) AS p5,
         quantile_disc(price_clean, 0.95) AS p95,
         quantile_disc(price_clean, 0.99) AS p99,
         COUNT(price_clean) AS n
  FROM priced
)"""

TRIMMED = r"""
trimmed AS (
  SELECT priced.* FROM priced, qs
  WHERE price_clean IS NULL OR (price_clean >= qs.p1 AND price_clean <= qs.p99)
)"""

MED = r"""
med AS (SELECT quantile_disc(price_clean, 0.5) AS med FROM trimmed)"""

FINAL = r"""
final AS (
  SELECT id, name, host_id, host_name, neighbourhood_group, neighbourhood,
         latitude, longitude, room_type, minimum_nights, number_of_reviews, last_review,
         reviews_per_month, calculated_host_listings_count, availability_365,
         number_of_reviews_ltm, license,
         COALESCE(price_clean, med.med) AS price
  FROM trimmed, med
)"""

_CHAIN = [
    ("raw", RAW),
    ("typed", TYPED),
    ("filled", FILLED),
    ("located", LOCATED),
    ("boxed", BOXED),
    ("priced", PRICED),
    ("qs", QS),
    ("trimmed", TRIMMED),
    ("med", MED),
    ("final", FINAL),
]


def with_listings(upto: str, body: str, extra: str = "") -> str:
    """``WITH`` clause holding the listings chain up to stage ``upto``."""
    ctes = []
    for name, sql in _CHAIN:
        ctes.append(sql.strip())
        if name == upto:
            break
    if extra:
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body


NEIGHBOURHOODS = r"""
neighbourhoods_raw AS (
  SELECT CASE WHEN n_regionkey = 0 THEN NULL ELSE r_name END AS neighbourhood_group, n_name AS neighbourhood
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

REVIEWS = r"""
reviews_raw AS (
  SELECT CASE WHEN l_orderkey % 163 = 0 THEN NULL ELSE l_partkey END AS listing_id,
         CASE WHEN l_orderkey % 157 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date
  FROM lineitem
)"""

LISTING_COLUMNS_SQL = (
    "id, name, host_id, host_name, neighbourhood_group, neighbourhood, latitude, longitude, "
    "room_type, minimum_nights, number_of_reviews, last_review, reviews_per_month, "
    "calculated_host_listings_count, availability_365, number_of_reviews_ltm, license, price"
)


def _null_profile(source: str, columns: list[str]) -> str:
    parts = [
        f"SELECT {i} AS position, '{c}' AS column_name, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {source}"
        for i, c in enumerate(columns)
    ]
    return "\nUNION ALL\n".join(parts)


RAW_COLUMNS = [
    "id", "name", "host_id", "host_name", "neighbourhood_group", "neighbourhood",
    "latitude", "longitude", "room_type", "price", "minimum_nights", "number_of_reviews",
    "last_review", "reviews_per_month", "calculated_host_listings_count",
    "availability_365", "number_of_reviews_ltm", "license",
]
FINAL_COLUMNS = [c for c in RAW_COLUMNS if c != "price"] + ["price"]


def _describe(source: str, columns: list[str], digits: int = 6) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, "
        f"ROUND(AVG(CAST({c} AS DOUBLE)), {digits}) AS mean, "
        f"ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), {digits}) AS stddev, "
        f"MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max FROM {source}"
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


def oracle_queries() -> dict[str, str]:
    band = (
        "CASE WHEN price < 30000 THEN 'Económico (<30k)' "
        "WHEN price < 60000 THEN 'Moderado (30k-60k)' "
        "WHEN price < 100000 THEN 'Caro (60k-100k)' ELSE 'Premium (>100k)' END"
    )
    q: dict[str, str] = {}
    q["csv_typed_cast"] = with_listings("typed", "SELECT * FROM typed")
    q["csv_roundtrip"] = with_listings("typed", "SELECT * FROM typed")
    q["fill_constants"] = with_listings(
        "filled",
        "SELECT id, name, host_name, neighbourhood_group, reviews_per_month, minimum_nights FROM filled",
    )
    q["fill_dimension"] = with_listings(
        "raw",
        "SELECT COALESCE(neighbourhood_group, 'Grupo_No_Especificado') AS neighbourhood_group, "
        "neighbourhood FROM (SELECT DISTINCT neighbourhood_group, neighbourhood FROM raw)",
    )
    q["null_group_rows"] = with_listings(
        "raw",
        "SELECT DISTINCT neighbourhood_group, neighbourhood FROM raw WHERE neighbourhood_group IS NULL",
    )
    q["drop_missing_coords"] = with_listings("located", "SELECT id, latitude, longitude FROM located")
    q["geo_stats"] = with_listings(
        "located",
        """
SELECT COUNT(*) AS rows,
       COUNT(latitude) AS lat_count, ROUND(AVG(latitude), 6) AS lat_mean,
       ROUND(STDDEV_SAMP(latitude), 6) AS lat_stddev, MIN(latitude) AS lat_min, MAX(latitude) AS lat_max,
       COUNT(longitude) AS lon_count, ROUND(AVG(longitude), 6) AS lon_mean,
       ROUND(STDDEV_SAMP(longitude), 6) AS lon_stddev, MIN(longitude) AS lon_min, MAX(longitude) AS lon_max,
       COUNT(*) FILTER (WHERE latitude < -33.8e0 OR latitude > -33.0e0
                          OR longitude < -70.9e0 OR longitude > -70.2e0) AS out_of_range,
       ROUND(100e0 * COUNT(*) FILTER (WHERE latitude < -33.8e0 OR latitude > -33.0e0
                          OR longitude < -70.9e0 OR longitude > -70.2e0) / COUNT(*), 4) AS pct_out_of_range
FROM located""",
    )
    q["geo_outside_sample"] = with_listings(
        "located",
        """
SELECT id, name, neighbourhood, latitude, longitude FROM located
WHERE latitude < -33.8e0 OR latitude > -33.0e0 OR longitude < -70.9e0 OR longitude > -70.2e0
ORDER BY id LIMIT 10""",
    )
    q["geo_inside"] = with_listings("boxed", "SELECT id, latitude, longitude FROM boxed")
    q["price_clean"] = with_listings("priced", "SELECT id, price, price_clean FROM priced")
    q["price_nulls"] = with_listings(
        "priced",
        """
SELECT COUNT(*) AS rows,
       COUNT(*) FILTER (WHERE price IS NULL) AS null_prices,
       COUNT(*) FILTER (WHERE price IS NOT NULL) AS valid_prices,
       COUNT(*) FILTER (WHERE price IS NOT NULL AND price_clean IS NULL) AS unparsed_prices
FROM priced""",
    )
    q["price_percentiles"] = with_listings("qs", "SELECT n, p1, p5, p95, p99 FROM qs")
    q["bigint_percentiles"] = f"""
SELECT COUNT(*) AS n, quantile_disc(k, 0.01) AS p1, quantile_disc(k, 0.05) AS p5,
       quantile_disc(k, 0.95) AS p95, quantile_disc(k, 0.99) AS p99
FROM (SELECT l_orderkey % 1000000 * 1000000000000 + l_partkey + {2**53} AS k FROM lineitem)"""
    q["price_trim"] = with_listings("trimmed", "SELECT id, price_clean FROM trimmed")
    q["price_median_fill"] = with_listings("final", "SELECT id, price FROM final")
    q["clean_listings_full"] = with_listings("final", f"SELECT {LISTING_COLUMNS_SQL} FROM final")
    q["parquet_roundtrip"] = q["clean_listings_full"]
    q["csv_clean_listings"] = q["clean_listings_full"]
    q["load_or_build"] = q["clean_listings_full"]
    q["partitioned_read"] = with_listings(
        "final", f"SELECT {LISTING_COLUMNS_SQL} FROM final WHERE room_type = '1-URGENT'"
    )
    q["step_accounting"] = with_listings(
        "final",
        """
SELECT position, step, rows_in, rows_out, rows_in - rows_out AS removed, values_filled FROM (
  SELECT 1 AS position, 'drop_missing_coords' AS step, (SELECT COUNT(*) FROM raw) AS rows_in,
         (SELECT COUNT(*) FROM located) AS rows_out, 0 AS values_filled
  UNION ALL SELECT 2, 'geo_box', (SELECT COUNT(*) FROM located), (SELECT COUNT(*) FROM boxed), 0
  UNION ALL SELECT 3, 'price_trim', (SELECT COUNT(*) FROM boxed), (SELECT COUNT(*) FROM trimmed), 0
  UNION ALL SELECT 4, 'price_median_fill', (SELECT COUNT(*) FROM trimmed), (SELECT COUNT(*) FROM trimmed),
                   (SELECT COUNT(*) FROM trimmed WHERE price_clean IS NULL)
) s""",
    )
    q["etl_verification"] = with_listings(
        "final",
        """
SELECT 'listings' AS dataset, COUNT(*) AS rows_expected, COUNT(*) AS rows_read, 18 AS columns,
       TRUE AS schema_ok, TRUE AS content_ok FROM final
UNION ALL
SELECT 'neighbourhoods', COUNT(*), COUNT(*), 2, TRUE, TRUE FROM nation
UNION ALL
SELECT 'reviews', COUNT(*), COUNT(*), 2, TRUE, TRUE
FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)""",
        extra=REVIEWS,
    )
    q["etl_observed_accounting"] = q["step_accounting"]
    q["dedup_reviews"] = f"WITH {REVIEWS.strip()} SELECT DISTINCT listing_id, date FROM reviews_raw"
    q["stream_dedup_reviews"] = q["stream_dedup_stored"] = q["dedup_reviews"]
    q["duplicate_count"] = f"""WITH {REVIEWS.strip()}
SELECT COUNT(*) AS rows,
       (SELECT COUNT(*) FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)) AS distinct_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)) AS duplicates
FROM reviews_raw"""
    q["dedup_by_key"] = """
SELECT CASE WHEN l_orderkey % 163 = 0 THEN NULL ELSE l_partkey END AS listing_id,
       CASE WHEN l_orderkey % 157 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date,
       MIN(l_orderkey) AS l_orderkey
FROM lineitem GROUP BY 1, 2"""
    q["null_profile"] = with_listings("raw", _null_profile("raw", RAW_COLUMNS))
    q["raw_null_profiles"] = with_listings(
        "raw",
        "SELECT 'listings' AS dataset, * FROM (" + _null_profile("raw", RAW_COLUMNS) + ")\nUNION ALL\n"
        "SELECT 'neighbourhoods', * FROM (" + _null_profile("neighbourhoods_raw", ["neighbourhood_group", "neighbourhood"]) + ")\nUNION ALL\n"
        "SELECT 'reviews', * FROM (" + _null_profile("reviews_raw", ["listing_id", "date"]) + ")",
        extra=NEIGHBOURHOODS + "," + REVIEWS,
    )
    q["raw_duplicates"] = with_listings(
        "raw",
        """
SELECT 'listings' AS dataset, COUNT(*) AS rows,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw)) AS distinct_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw)) AS duplicates
FROM raw
UNION ALL
SELECT 'neighbourhoods', COUNT(*), (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM neighbourhoods_raw)),
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM neighbourhoods_raw))
FROM neighbourhoods_raw
UNION ALL
SELECT 'reviews', COUNT(*), (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM reviews_raw)),
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM reviews_raw))
FROM reviews_raw""",
        extra=NEIGHBOURHOODS + "," + REVIEWS,
    )
    q["row_counts"] = """
SELECT 'listings' AS dataset, COUNT(*) AS rows FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL SELECT 'neighbourhoods', COUNT(*) FROM nation
UNION ALL SELECT 'reviews', COUNT(*) FROM lineitem"""
    q["describe_numeric"] = with_listings("final", _describe("final", list(DESCRIBE_COLUMNS)))
    q["distinct_price"] = with_listings("boxed", "SELECT DISTINCT price FROM boxed")
    q["column_preview"] = with_listings(
        "final", "SELECT id, name, neighbourhood, room_type, price FROM final ORDER BY id LIMIT 5"
    )
    q["group_count"] = with_listings(
        "final", "SELECT room_type, COUNT(*) AS count FROM final GROUP BY room_type"
    )
    q["top10_groups"] = with_listings(
        "final",
        "SELECT neighbourhood, COUNT(*) AS count FROM final GROUP BY neighbourhood "
        "ORDER BY count DESC, neighbourhood LIMIT 10",
    )
    q["price_by_group"] = with_listings(
        "final",
        "SELECT room_type, MIN(price) AS precio_min, MAX(price) AS precio_max, "
        "ROUND(AVG(price), 2) AS precio_promedio, COUNT(price) AS cantidad FROM final GROUP BY room_type",
    )
    q["price_overall"] = with_listings(
        "final",
        "SELECT MIN(price) AS min, MAX(price) AS max, ROUND(AVG(price), 2) AS avg, "
        "COUNT(price) AS count FROM final",
    )
    q["top5_expensive"] = with_listings(
        "final",
        f"""
SELECT neighbourhood, ROUND(AVG(price), 2) AS precio_promedio, COUNT(*) AS total_propiedades
FROM final GROUP BY neighbourhood HAVING COUNT(*) >= {TOP_EXPENSIVE_MIN_COUNT}
ORDER BY precio_promedio DESC, neighbourhood LIMIT {TOP_EXPENSIVE_K}""",
    )
    q["band_distribution"] = with_listings(
        "final",
        f"SELECT room_type, {band} AS rango_precio, COUNT(*) AS cantidad FROM final GROUP BY 1, 2",
    )
    q["review_stats"] = with_listings(
        "final",
        f"""
SELECT neighbourhood, COUNT(*) AS total_propiedades,
       ROUND(AVG(number_of_reviews), 1) AS promedio_resenas,
       ROUND(AVG(reviews_per_month), 2) AS resenas_por_mes,
       ROUND(AVG(price), 0) AS precio_promedio
FROM final GROUP BY neighbourhood HAVING COUNT(*) >= {REVIEW_STATS_MIN_COUNT}
ORDER BY promedio_resenas DESC, neighbourhood LIMIT {REVIEW_STATS_K}""",
    )
    q["reduction_table"] = with_listings(
        "final",
        """
SELECT 'listings' AS dataset, (SELECT COUNT(*) FROM raw) AS initial, (SELECT COUNT(*) FROM final) AS final,
       ROUND((1 - (SELECT COUNT(*) FROM final) / (SELECT COUNT(*) FROM raw)) * 100, 2) AS pct_reduction
UNION ALL
SELECT 'neighbourhoods', (SELECT COUNT(*) FROM nation), (SELECT COUNT(*) FROM nation), 0e0
UNION ALL
SELECT 'reviews', (SELECT COUNT(*) FROM lineitem),
       (SELECT COUNT(*) FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)),
       ROUND((1 - (SELECT COUNT(*) FROM (SELECT DISTINCT listing_id, date FROM reviews_raw))
                  / (SELECT COUNT(*) FROM lineitem)) * 100, 2)""",
        extra=REVIEWS,
    )
    q["top_nulls"] = with_listings(
        "final",
        f"""
SELECT b.column_name, b.null_count AS nulls_raw, CAST(COALESCE(a.null_count, 0) AS BIGINT) AS nulls_final
FROM ({_null_profile("raw", RAW_COLUMNS)}) b
LEFT JOIN ({_null_profile("final", FINAL_COLUMNS)}) a ON a.column_name = b.column_name
ORDER BY nulls_raw DESC, b.column_name LIMIT 10""",
    )
    q["duplicates_before_after"] = f"""WITH {REVIEWS.strip()}
SELECT 'raw' AS stage, COUNT(*) AS rows,
       (SELECT COUNT(*) FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)) AS distinct_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)) AS duplicates
FROM reviews_raw
UNION ALL
SELECT 'clean', COUNT(*), COUNT(*), 0 FROM (SELECT DISTINCT listing_id, date FROM reviews_raw)"""
    q["ref_integrity"] = with_listings(
        "final",
        "SELECT id, neighbourhood FROM final "
        "WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_name = final.neighbourhood)",
    )
    q["reviews_per_month"] = f"""WITH {REVIEWS.strip()}
SELECT CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS reviews
FROM (SELECT DISTINCT listing_id, date FROM reviews_raw) GROUP BY 1"""
    return q | storage_queries(with_listings, RAW_COLUMNS, band, REVIEWS)
