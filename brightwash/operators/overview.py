"""All grouped analyses of the clean listings from one scan.

One aggregate over grouping sets (by neighbourhood, by room type, by room type
and price band, over everything) yields every count, bound and mean; the
ranked and ordered analyses are read off its few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwash.config import (
    REVIEW_STATS_K,
    REVIEW_STATS_MIN_COUNT,
    TOP_EXPENSIVE_K,
    TOP_EXPENSIVE_MIN_COUNT,
    TOP_GROUPS_K,
)
from brightwash.functions.bands import price_band


def grouped_states(df: DataFrame) -> DataFrame:
    """One row per group of each grouping set, told apart by ``grouping_id``."""
    place, room, band = "neighbourhood", "room_type", "rango_precio"
    rows = df.select(
        place, room, price_band(F.col("price")).alias(band), "price", "number_of_reviews", "reviews_per_month"
    )
    sets = [[F.col(place)], [F.col(room)], [F.col(room), F.col(band)], []]
    return rows.groupingSets(sets, F.col(place), F.col(room), F.col(band)).agg(
        F.grouping_id(place, room, band).alias("grouping_id"),
        F.count(F.lit(1)).alias("total"),
        F.count("price").alias("precios"),
        F.min("price").alias("precio_min"),
        F.max("price").alias("precio_max"),
        F.avg("price").alias("precio_promedio"),
        F.avg("number_of_reviews").alias("promedio_resenas"),
        F.avg("reviews_per_month").alias("resenas_por_mes"),
    )


# bits of a grouping id: neighbourhood 4, room type 2, band 1; set where not grouped
_BY_PLACE, _BY_ROOM, _BY_BAND, _OVERALL = 3, 5, 4, 7


def listing_overview(
    df: DataFrame,
    top_expensive: tuple[int, int] = (TOP_EXPENSIVE_MIN_COUNT, TOP_EXPENSIVE_K),
    review_stats: tuple[int, int] = (REVIEW_STATS_MIN_COUNT, REVIEW_STATS_K),
    top_groups: int = TOP_GROUPS_K,
) -> DataFrame:
    """(analysis, position, neighbourhood, room_type, rango_precio, total,
    precios, precio_min, precio_max, precio_promedio, promedio_resenas,
    resenas_por_mes), ``position`` being the row's place in its analysis.

    The six analyses (``top_expensive`` and ``review_stats`` as pairs of smallest
    group and number of rows) and the overall row, in one table. Means are
    rounded to two digits (reviews to one).
    """
    rows = grouped_states(df).withColumns(
        {
            "precio_promedio": F.round("precio_promedio", 2),
            "promedio_resenas": F.round("promedio_resenas", 1),
            "resenas_por_mes": F.round("resenas_por_mes", 2),
        }
    )

    def ranked(grouping: int, order: list[Column], least: int = 0, size: int | None = None) -> Column:
        """A row's place among the rows of its grouping, else NULL."""
        taking_part = (F.col("grouping_id") == grouping) & (F.col("total") >= least)
        place = F.row_number().over(Window.partitionBy(taking_part.alias("in"), "grouping_id").orderBy(*order))
        kept = taking_part if size is None else taking_part & (place <= size)
        return F.when(kept, place)

    by = lambda column, *keys: [F.desc(column), *[F.col(k) for k in keys]]
    analyses = {
        "top_expensive": ranked(_BY_PLACE, by("precio_promedio", "neighbourhood"), *top_expensive),
        "band_distribution": ranked(_BY_BAND, [F.col("room_type"), *by("total", "rango_precio")]),
        "review_stats": ranked(_BY_PLACE, by("promedio_resenas", "neighbourhood"), *review_stats),
        "group_count": ranked(_BY_ROOM, by("total", "room_type")),
        "top_groups": ranked(_BY_PLACE, by("total", "neighbourhood"), 0, top_groups),
        "value_by_group": ranked(_BY_ROOM, by("precio_promedio", "room_type")),
        "value_overall": ranked(_OVERALL, [F.desc("total")]),
    }
    placed = rows.withColumns({f"at_{name}": place for name, place in analyses.items()})
    found = F.array(
        *[F.struct(F.lit(name).alias("analysis"), F.col(f"at_{name}").alias("position")) for name in analyses]
    )
    return placed.select(
        F.inline(F.filter(found, lambda a: a["position"].isNotNull())),
        "neighbourhood", "room_type", "rango_precio", "total", "precios",
        "precio_min", "precio_max", "precio_promedio", "promedio_resenas", "resenas_por_mes",
    )
