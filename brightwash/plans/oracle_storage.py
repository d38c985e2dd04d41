"""Independent SQL (DuckDB dialect) for the queries on storing, inferring,
comparing and profiling tables, and on trends."""

from __future__ import annotations

from brightwash.config import (
    REVIEW_STATS_K,
    REVIEW_STATS_MIN_COUNT,
    TOP_EXPENSIVE_K,
    TOP_EXPENSIVE_MIN_COUNT,
    TOP_GROUPS_K,
)

# the CSV fixture: records broken by rule do not count
_WHOLE = "(id % 173 <> 0 AND id % 179 <> 0)"
_OUTCOME = r"""
CASE WHEN v IS NULL OR v IN ('', 'NULL') THEN NULL
     WHEN lower(v) IN ('true', 'false') THEN 'boolean'
     WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS INTEGER) IS NOT NULL THEN 'int'
     WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN 'bigint'
     WHEN regexp_full_match(v, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 'double'
     WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL THEN 'date'
     WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?')
          AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 'timestamp'
     ELSE 'string' END"""


def _values(columns: list[str]) -> str:
    rows = [
        f"SELECT {i} AS position, '{c}' AS \"column\", id, CAST({c} AS VARCHAR) AS v FROM raw WHERE {_WHOLE}"
        for i, c in enumerate(columns)
    ]
    return "\nUNION ALL ".join(rows)


def _inferred(columns: list[str]) -> str:
    return f"""
outcomes AS (SELECT position, "column", id, v, {_OUTCOME} AS o FROM ({_values(columns)})),
states AS (
  SELECT position, "column", COUNT(o) AS filled,
         COUNT(*) FILTER (WHERE o = 'boolean') AS b, COUNT(*) FILTER (WHERE o = 'int') AS i,
         COUNT(*) FILTER (WHERE o IN ('int', 'bigint')) AS l, COUNT(*) FILTER (WHERE o IN ('int', 'bigint', 'double')) AS d,
         COUNT(*) FILTER (WHERE o = 'date') AS t, COUNT(*) FILTER (WHERE o IN ('date', 'timestamp')) AS s
  FROM outcomes GROUP BY position, "column"),
types AS (
  SELECT position, "column", filled,
         CASE WHEN filled = 0 THEN 'string' WHEN filled - b <= 0.05e0 * filled THEN 'boolean'
              WHEN filled - i <= 0.05e0 * filled THEN 'int' WHEN filled - l <= 0.05e0 * filled THEN 'bigint'
              WHEN filled - d <= 0.05e0 * filled THEN 'double' WHEN filled - t <= 0.05e0 * filled THEN 'date'
              WHEN filled - s <= 0.05e0 * filled THEN 'timestamp' ELSE 'string' END AS type,
         CASE WHEN filled = 0 THEN 0 WHEN filled - b <= 0.05e0 * filled THEN filled - b
              WHEN filled - i <= 0.05e0 * filled THEN filled - i WHEN filled - l <= 0.05e0 * filled THEN filled - l
              WHEN filled - d <= 0.05e0 * filled THEN filled - d WHEN filled - t <= 0.05e0 * filled THEN filled - t
              WHEN filled - s <= 0.05e0 * filled THEN filled - s ELSE 0 END AS misfits
  FROM states)"""


# the values of a type, by outcome; a string holds all
_FITS = """(CASE t.type WHEN 'boolean' THEN o = 'boolean' WHEN 'int' THEN o = 'int' WHEN 'bigint' THEN o IN ('int', 'bigint')
      WHEN 'double' THEN o IN ('int', 'bigint', 'double') WHEN 'date' THEN o = 'date'
      WHEN 'timestamp' THEN o IN ('date', 'timestamp') ELSE TRUE END)"""


def _state_profile(columns: list[str], numbers: set[str]) -> str:
    parts = []
    for i, c in enumerate(columns):
        v = f"CAST({c} AS DOUBLE)" if c in numbers else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT {i} AS position, '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, "
            f"COUNT({v}) AS numbers, MIN({v}) AS low, MAX({v}) AS high, ROUND(AVG({v}), 6) AS mean, "
            f"ROUND(STDDEV_SAMP({v}), 6) AS stddev FROM raw"
        )
    return "\nUNION ALL ".join(parts)


_OVERVIEW_COLUMNS = (
    "analysis, CAST(position AS INTEGER) AS position, neighbourhood, room_type, rango_precio, total, precios, "
    "precio_min, precio_max, precio_promedio, promedio_resenas, resenas_por_mes"
)
_MEASURES = (
    "COUNT(*) AS total, COUNT(price) AS precios, MIN(price) AS precio_min, MAX(price) AS precio_max, "
    "ROUND(AVG(price), 2) AS precio_promedio, ROUND(AVG(number_of_reviews), 1) AS promedio_resenas, "
    "ROUND(AVG(reviews_per_month), 2) AS resenas_por_mes"
)


def _analysis(name: str, keys: tuple[str, ...], order: str, having: str = "", limit: str = "") -> str:
    dims = ", ".join(k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}" for k in ("neighbourhood", "room_type", "rango_precio"))
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return (
        f"SELECT '{name}' AS analysis, row_number() OVER (ORDER BY {order}) AS position, * FROM "
        f"(SELECT {dims}, {_MEASURES} FROM banded {group} {having}) {limit}"
    )


def storage_queries(with_listings, raw_columns: list[str], band: str, reviews: str) -> dict[str, str]:
    numbers = {
        "id", "host_id", "latitude", "longitude", "number_of_reviews", "reviews_per_month",
        "calculated_host_listings_count", "availability_365", "number_of_reviews_ltm",
    }
    kept = "(SELECT DISTINCT listing_id, date FROM reviews_raw) WHERE date >= DATE"
    q: dict[str, str] = {}
    q["store_reuse"] = f"""WITH {reviews.strip()}
SELECT 1 AS step, FALSE AS hit, COUNT(*) AS rows FROM {kept} '1990-01-01'
UNION ALL SELECT 2, TRUE, COUNT(*) FROM {kept} '1990-01-01'
UNION ALL SELECT 3, FALSE, COUNT(*) FROM {kept} '1996-01-01'
UNION ALL SELECT 4, TRUE, COUNT(*) FROM {kept} '1996-01-01'"""
    q["csv_inferred_types"] = with_listings(
        "raw",
        'SELECT position, "column", type, filled, misfits, '
        f"(SELECT COUNT(*) FROM raw WHERE NOT {_WHOLE}) AS corrupt_rows FROM types",
        extra=_inferred(raw_columns),
    )
    q["csv_quarantine"] = with_listings(
        "raw",
        f"""
SELECT x.id, t."column" AS column_name, v AS value FROM outcomes x JOIN types t USING (position)
WHERE o IS NOT NULL AND NOT {_FITS}
UNION ALL SELECT id, '*', NULL FROM raw WHERE NOT {_WHOLE}""",
        extra=_inferred(raw_columns),
    )
    missing = lambda c: f"CASE WHEN {c} IN ('', 'NULL') THEN NULL ELSE {c} END AS {c}"
    whole = {"id", "host_id", "number_of_reviews", "calculated_host_listings_count", "availability_365", "number_of_reviews_ltm"}
    typed = [
        "CAST(minimum_nights AS INTEGER) AS minimum_nights" if c == "minimum_nights"
        else f"CAST({c} AS INTEGER) AS {c}" if c in whole
        else f"CAST({c} AS DATE) AS {c}" if c == "last_review"
        else c if c in numbers
        else missing(c)
        for c in raw_columns
    ]
    q["csv_inferred_table"] = with_listings(
        "raw",
        f"""SELECT {', '.join(typed)}
FROM (SELECT * REPLACE (CASE WHEN minimum_nights = '' THEN NULL ELSE minimum_nights END AS minimum_nights) FROM raw
      WHERE {_WHOLE} AND (minimum_nights IS NULL OR minimum_nights NOT IN ('3.7', 'x')))""",
    )
    q["clustered_box_read"] = with_listings(
        "located",
        "SELECT id, latitude, longitude, room_type FROM located "
        "WHERE latitude BETWEEN -33.55e0 AND -33.45e0 AND longitude BETWEEN -70.6e0 AND -70.4e0",
    )
    q["table_differences"] = """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
changed AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1019 = 0 OR o_orderkey % 2026 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 1013 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM a WHERE o_orderkey % 1009 <> 0),
b AS (
  SELECT * FROM changed
  UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM a WHERE o_orderkey % 1021 = 0
  UNION ALL SELECT * FROM changed WHERE o_orderkey % 1031 = 0),
an AS (SELECT o_orderkey, COUNT(*) AS n, ANY_VALUE(o_custkey) AS c, ANY_VALUE(o_orderstatus) AS s, ANY_VALUE(o_totalprice) AS p FROM a GROUP BY 1),
bn AS (SELECT o_orderkey, COUNT(*) AS n, ANY_VALUE(o_custkey) AS c, ANY_VALUE(o_orderstatus) AS s, ANY_VALUE(o_totalprice) AS p FROM b GROUP BY 1)
SELECT COALESCE(an.o_orderkey, bn.o_orderkey) AS o_orderkey,
       CASE WHEN bn.n IS NULL THEN 'removed' WHEN an.n IS NULL THEN 'added' ELSE 'changed' END AS change,
       COALESCE(an.n, 0) AS rows_left, COALESCE(bn.n, 0) AS rows_right,
       CASE WHEN an.n = 1 AND bn.n = 1 THEN concat_ws(',', CASE WHEN an.c IS DISTINCT FROM bn.c THEN 'o_custkey' END,
            CASE WHEN an.s IS DISTINCT FROM bn.s THEN 'o_orderstatus' END, CASE WHEN an.p IS DISTINCT FROM bn.p THEN 'o_totalprice' END) END AS columns
FROM an FULL JOIN bn ON an.o_orderkey = bn.o_orderkey
WHERE an.n IS DISTINCT FROM bn.n OR an.c IS DISTINCT FROM bn.c OR an.s IS DISTINCT FROM bn.s OR an.p IS DISTINCT FROM bn.p"""
    q["incremental_profile"] = with_listings("raw", _state_profile(raw_columns, numbers))
    q["top_nulls_from_states"] = with_listings(
        "raw",
        f"SELECT column_name, nulls FROM ({_state_profile(raw_columns, set())}) ORDER BY nulls DESC, column_name LIMIT 10",
    )
    analyses = [
        _analysis("top_expensive", ("neighbourhood",), "precio_promedio DESC, neighbourhood", f"HAVING COUNT(*) >= {TOP_EXPENSIVE_MIN_COUNT}", f"QUALIFY position <= {TOP_EXPENSIVE_K}"),
        _analysis("band_distribution", ("room_type", "rango_precio"), "room_type NULLS FIRST, total DESC, rango_precio"),
        _analysis("review_stats", ("neighbourhood",), "promedio_resenas DESC, neighbourhood", f"HAVING COUNT(*) >= {REVIEW_STATS_MIN_COUNT}", f"QUALIFY position <= {REVIEW_STATS_K}"),
        _analysis("group_count", ("room_type",), "total DESC, room_type NULLS FIRST"),
        _analysis("top_groups", ("neighbourhood",), "total DESC, neighbourhood", "", f"QUALIFY position <= {TOP_GROUPS_K}"),
        _analysis("value_by_group", ("room_type",), "precio_promedio DESC, room_type NULLS FIRST"),
        _analysis("value_overall", (), "total"),
    ]
    q["listing_overview"] = with_listings(
        "final",
        f"SELECT {_OVERVIEW_COLUMNS} FROM (" + "\nUNION ALL ".join(f"({a})" for a in analyses) + ")",
        extra=f"banded AS (SELECT *, {band} AS rango_precio FROM final)",
    )
    q["host_trends"] = with_listings(
        "raw",
        """
SELECT host_id, month, rows, ROUND(AVG(rows) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_mean,
       rows - LAG(rows) OVER w AS change,
       ROUND(rows / MAX(rows) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS share_of_peak
FROM (SELECT host_id, m.month, COUNT(c.month) AS rows
      FROM months m LEFT JOIN counted c USING (host_id, month) GROUP BY host_id, m.month)
WINDOW w AS (PARTITION BY host_id ORDER BY month)""",
        extra="""
counted AS (SELECT host_id, CAST(date_trunc('month', CAST(last_review AS DATE)) AS DATE) AS month FROM raw WHERE last_review IS NOT NULL),
months AS (
  SELECT host_id, CAST(unnest(generate_series(MIN(month), MAX(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM counted GROUP BY host_id)""",
    )
    q["orphans_large_dimension"] = (
        "SELECT c_custkey AS custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')"
    )
    q["file_counts"] = """
SELECT 'listings' AS dataset, COUNT(*) AS rows, CAST(1 AS BIGINT) AS files FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL SELECT 'neighbourhoods', COUNT(*), 1 FROM nation
UNION ALL SELECT 'reviews', COUNT(*), 4 FROM lineitem"""
    q["planned_files"] = """
SELECT CAST(CEIL(COUNT(*) / 20000e0) AS BIGINT) AS planned, CAST(CEIL(COUNT(*) / 20000e0) AS BIGINT) AS files,
       COUNT(*) AS rows, TRUE AS even FROM lineitem"""
    q["compacted_files"] = "SELECT COUNT(*) AS rows, TRUE AS same_rows, TRUE AS fewer_files FROM lineitem"
    return q
