"""Parameters of the cleaning and analytics flow.

The defaults reproduce the behaviour the engine was built to match; every
value can be overridden by passing another dataclass instance.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values that must equal the behaviour being matched -------------
# Missing-value sentinels in text columns.
MISSING_TEXT = ("", "NULL")
# Fill labels for listings and for the neighbourhood dimension.
FILL_NEIGHBOURHOOD_GROUP = "Sin_Grupo"
FILL_HOST_NAME = "Host_Desconocido"
FILL_NAME = "Propiedad_Sin_Nombre"
FILL_REVIEWS_PER_MONTH = 0.0
FILL_MINIMUM_NIGHTS = 1
FILL_DIMENSION_GROUP = "Grupo_No_Especificado"
# Bounding box (Santiago de Chile): latitude, then longitude, both inclusive.
MIN_LAT, MAX_LAT = -33.8, -33.0
MIN_LON, MAX_LON = -70.9, -70.2
# Price percentiles reported, the trim range and the fill quantile.
PRICE_PERCENTILES = (0.01, 0.05, 0.95, 0.99)
TRIM_LOW, TRIM_HIGH = 0.01, 0.99
FILL_QUANTILE = 0.5
# Price bands: upper bounds (exclusive) and labels, last label is the rest.
PRICE_BAND_LIMITS = (30000, 60000, 100000)
PRICE_BAND_LABELS = (
    "Económico (<30k)",
    "Moderado (30k-60k)",
    "Caro (60k-100k)",
    "Premium (>100k)",
)
# Minimum group sizes and result sizes of the three analytical queries.
TOP_EXPENSIVE_MIN_COUNT, TOP_EXPENSIVE_K = 50, 5
REVIEW_STATS_MIN_COUNT, REVIEW_STATS_K = 100, 10
TOP_GROUPS_K = 10
TOP_NULLS_K = 10
# Columns described, and columns and rows of the preview.
DESCRIBE_COLUMNS = ("price", "latitude", "longitude", "minimum_nights", "number_of_reviews", "reviews_per_month")
PREVIEW_COLUMNS, PREVIEW_ROWS = ("id", "name", "neighbourhood", "room_type", "price"), 5
# --------------------------------------------------------------------------

# Target types of the listings columns (ids are 64-bit: a 32-bit cast turns
# large ids into NULL).
LISTING_TYPES: dict[str, str] = {
    "id": "bigint",
    "host_id": "bigint",
    "minimum_nights": "int",
    "number_of_reviews": "int",
    "calculated_host_listings_count": "int",
    "number_of_reviews_ltm": "int",
    "availability_365": "int",
    "latitude": "double",
    "longitude": "double",
    "reviews_per_month": "double",
    "last_review": "date",
}


@dataclass(frozen=True)
class Box:
    """Inclusive latitude / longitude bounds."""

    min_lat: float = MIN_LAT
    max_lat: float = MAX_LAT
    min_lon: float = MIN_LON
    max_lon: float = MAX_LON


@dataclass(frozen=True)
class ListingsParams:
    """Everything ``clean_listings`` needs to know."""

    types: dict[str, str] = field(default_factory=lambda: dict(LISTING_TYPES))
    fills: dict[str, object] = field(
        default_factory=lambda: {
            "neighbourhood_group": FILL_NEIGHBOURHOOD_GROUP,
            "host_name": FILL_HOST_NAME,
            "name": FILL_NAME,
            "reviews_per_month": FILL_REVIEWS_PER_MONTH,
            "minimum_nights": FILL_MINIMUM_NIGHTS,
        }
    )
    required: tuple[str, ...] = ("latitude", "longitude")
    box: Box = field(default_factory=Box)
    price_col: str = "price"
    trim: tuple[float, float] = (TRIM_LOW, TRIM_HIGH)
    fill_quantile: float = FILL_QUANTILE
    # "exact": distributed histogram refinement, equal to the discrete
    # quantile at any scale. "sketch": KLL sketches with k = ``accuracy`` (8 to
    # 65535) kept inside the plan, merged as a two-level tree (lazy).
    quantile_method: str = "exact"
    accuracy: int = 4096
