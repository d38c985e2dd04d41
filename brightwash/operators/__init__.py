"""DataFrame operators (``DataFrame -> DataFrame`` or one-row result frames)."""

from brightwash.operators.analytics import (
    band_distribution,
    band_distribution_sql,
    group_count,
    monthly_counts,
    orphans,
    review_stats,
    review_stats_sql,
    top_expensive,
    top_expensive_sql,
    top_groups,
    value_by_group,
    value_overall,
)
from brightwash.operators.dedup import dedup_by_key, dedup_rows, dedup_with_copies, duplicate_stats
from brightwash.operators.fill import drop_missing, fill_constants
from brightwash.operators.geo import filter_box, geo_profile, outside_rows, outside_sample
from brightwash.operators.joins import has_at_most, join_dimension
from brightwash.operators.price import (
    add_clean_price,
    fill_price,
    price_text_profile,
    price_value,
    trim_to_range,
)
from brightwash.operators.profile import (
    describe_numeric,
    distinct_values,
    null_counts,
    null_profile,
    preview,
    row_counts,
    schema_table,
    table_profile,
)
from brightwash.operators.quantiles import (
    RankSelector,
    exact_quantiles,
    quantile_table,
    quantile_values,
    sketch_quantile_columns,
    sketch_quantile_row,
)
from brightwash.operators.report import reduction_table, top_nulls
from brightwash.operators.types import convert_types

__all__ = [name for name in dir() if not name.startswith("_")]
