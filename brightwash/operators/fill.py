"""Constant fills and required-column filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwash.functions.predicates import all_not_null


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULL by a constant, per column, in one projection.

    ``coalesce`` only touches NULL: NaN in a double column stays NaN (unlike
    ``fillna``). The constant is cast to the column's type, so an int column
    stays int.
    """
    fields = {f.name: f.dataType for f in df.schema}
    exprs = {
        name: F.coalesce(F.col(name), F.lit(value).cast(fields[name]))
        for name, value in values.items()
        if name in fields
    }
    return df.withColumns(exprs) if exprs else df


def drop_missing(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Keep rows where every required column is non-NULL."""
    return df.filter(all_not_null(*required))
