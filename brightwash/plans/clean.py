"""Composite cleaning of the three tables, and one-pass step accounting."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brightwash.config import FILL_DIMENSION_GROUP, PRICE_PERCENTILES, ListingsParams
from brightwash.functions.predicates import all_not_null, in_box, null_or_between
from brightwash.operators.dedup import dedup_rows
from brightwash.operators.fill import drop_missing, fill_constants
from brightwash.operators.geo import filter_box
from brightwash.operators.price import add_clean_price, fill_price, price_value, trim_to_range
from brightwash.operators.quantiles import RankSelector, quantile_values
from brightwash.operators.types import convert_types


@dataclass
class CleanListings:
    """The cleaned table plus the intermediate frames and derived values.

    ``percentiles`` maps each reported quantile to a column (a literal for
    the exact method, a scalar subquery for sketches), ``median``
    is the fill value, ``stages`` holds the lazy frame after each step.
    """

    data: DataFrame
    stages: dict[str, DataFrame] = field(default_factory=dict)
    percentiles: dict[float, Column] = field(default_factory=dict)
    median: Column | None = None
    observations: dict[str, Observation] = field(default_factory=dict)

    def observed_accounting(self, spark: SparkSession, final_rows: int) -> DataFrame:
        """Step accounting from counts observed while the data ran.

        Needs ``clean_listings(..., observe=True)``: the raw, located and
        boxed counts and the NULL prices were observed during the write of
        the price column; ``final_rows`` is the row count observed while
        ``data`` was written. NULL prices always survive the trim, so they
        are the values filled. No extra pass over the source.
        """
        if not self.observations:
            raise ValueError("clean_listings was called without observe=True")
        n = {name: obs.get for name, obs in self.observations.items()}
        raw, located, boxed = n["raw"]["rows"], n["located"]["rows"], n["priced"]["rows"]
        trimmed, filled = int(final_rows), n["priced"]["null_prices"]
        rows = [
            (1, "drop_missing_coords", raw, located, raw - located, 0),
            (2, "geo_box", located, boxed, located - boxed, 0),
            (3, "price_trim", boxed, trimmed, boxed - trimmed, 0),
            (4, "price_median_fill", trimmed, trimmed, 0, filled),
        ]
        return spark.createDataFrame(
            rows,
            "position int, step string, rows_in long, rows_out long, removed long, values_filled long",
        )


def typed_and_filled(raw: DataFrame, params: ListingsParams = ListingsParams()) -> DataFrame:
    """Steps 1-2 without row changes: type correction and constant fills."""
    return fill_constants(convert_types(raw, params.types), params.fills)


def clean_listings(
    raw: DataFrame,
    params: ListingsParams = ListingsParams(),
    report_percentiles: tuple[float, ...] = PRICE_PERCENTILES,
    materialize: bool = True,
    observe: bool = False,
) -> CleanListings:
    """Types, fills, required coordinates, box, price text, trim, median fill.

    Everything is one lazy plan of projections and filters over the source
    except the quantiles: with the exact method they are computed by a few
    aggregation passes over the parsed price column (``materialize=True``
    first writes that one column to the shared checkpoint folder, worth it
    when the source is expensive to recompute, e.g. CSV parsing or a join;
    it is released once the values are known). The ``sketch`` method keeps
    them in the plan as scalar subqueries (no job at call time).

    ``observe=True`` attaches row counters to the stages (see
    :meth:`CleanListings.observed_accounting`): they are filled by the write
    of the price column, which runs anyway and reads every row to count it.
    ``data`` is built on a chain of its own without counters, so its filters
    and columns are pushed into its scan.
    """
    if observe and not (params.quantile_method == "exact" and materialize):
        # the counters must be filled by the price-column write, whose last
        # stage is where they sit
        raise ValueError("observe=True needs the exact method with materialize=True")
    observations: dict[str, Observation] = {}

    def watch(df: DataFrame, name: str, *extra: Column) -> DataFrame:
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        observations[name] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)

    raw_nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(raw.columns)]
    def chain(watch) -> dict[str, DataFrame]:
        typed = convert_types(watch(raw, "raw", *raw_nulls), params.types)
        filled = fill_constants(typed, params.fills)
        located = watch(drop_missing(filled, params.required), "located")
        boxed = filter_box(located, params.box)
        priced = watch(
            add_clean_price(boxed, params.price_col, "price_clean"),
            "priced",
            F.count_if(F.col("price_clean").isNull()).alias("null_prices"),
        )
        return {"typed": typed, "filled": filled, "located": located, "boxed": boxed, "priced": priced}

    stages = chain(lambda df, name, *extra: df)
    priced = stages["priced"]
    counted = chain(watch)["priced"] if observe else priced

    low_q, high_q = params.trim
    probs = sorted(set(report_percentiles) | {low_q, high_q})
    if params.quantile_method == "exact":
        selector = RankSelector(counted, "price_clean", materialize=materialize)
        # The median of the kept rows is a rank among all values, refined in
        # the same passes as the trim bounds.
        values, fill_value = selector.trimmed(probs, low_q, high_q, params.fill_quantile)
        selector.release()  # the values are literals from here on
        found = dict(zip(probs, values))
        by_q = {q: F.lit(x).cast("double") for q, x in found.items()}
        median = F.lit(fill_value).cast("double")
        trimmed = trim_to_range(priced, by_q[low_q], by_q[high_q])
    else:
        method = params.quantile_method
        by_q = dict(zip(probs, quantile_values(priced, "price_clean", probs, method, params.accuracy)))
        trimmed = trim_to_range(priced, by_q[low_q], by_q[high_q])
    if params.quantile_method != "exact":
        (median,) = quantile_values(
            trimmed, "price_clean", [params.fill_quantile], params.quantile_method, params.accuracy
        )
    final = fill_price(trimmed, median, params.price_col, "price_clean")
    return CleanListings(
        data=final,
        stages=stages | {"trimmed": trimmed},
        percentiles={q: by_q[q] for q in report_percentiles},
        median=median,
        observations=observations,
    )


def step_accounting(
    raw: DataFrame,
    trim_low: Column,
    trim_high: Column,
    params: ListingsParams = ListingsParams(),
) -> DataFrame:
    """``(position, step, rows_in, rows_out, removed)`` for every row filter.

    One scan: each row gets the flags of all steps, and a single aggregate
    counts the survivors of each prefix of the step list.
    """
    base = typed_and_filled(raw, params)
    has_coords = all_not_null(*params.required)
    inside = has_coords & in_box(params.box)
    price = price_value(base, params.price_col)
    kept = inside & null_or_between(price, trim_low, trim_high)
    # Flags are projected first, so the aggregate only sees plain columns
    # (trim bounds may be scalar subqueries of any kind).
    flags = base.select(
        has_coords.alias("_located"),
        inside.alias("_boxed"),
        kept.alias("_trimmed"),
        (kept & price.isNull()).alias("_filled"),
    )
    counts = flags.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("_located").alias("located"),
        F.count_if("_boxed").alias("boxed"),
        F.count_if("_trimmed").alias("trimmed"),
        F.count_if("_filled").alias("filled"),
    )
    return counts.selectExpr(
        "stack(4,"
        " 1, 'drop_missing_coords', raw, located,"
        " 2, 'geo_box', located, boxed,"
        " 3, 'price_trim', boxed, trimmed,"
        " 4, 'price_median_fill', trimmed, trimmed"
        ") AS (position, step, rows_in, rows_out)",
        "filled",
    ).select(
        "position",
        "step",
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("removed"),
        F.when(F.col("step") == "price_median_fill", F.col("filled"))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("values_filled"),
    )


def clean_neighbourhoods(raw: DataFrame, group_fill: str = FILL_DIMENSION_GROUP) -> DataFrame:
    """Fill the missing group label of the neighbourhood dimension."""
    return fill_constants(raw, {"neighbourhood_group": group_fill})


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Full-row deduplication of the reviews."""
    return dedup_rows(raw)
