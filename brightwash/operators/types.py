"""Type correction (one projection for all columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwash.functions.casts import convert_column


def convert_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Convert every listed column that exists; others pass through.

    Built as a single ``withColumns`` so the plan has one Project however
    many columns change.
    """
    fields = {f.name: f.dataType for f in df.schema}
    exprs = {
        name: convert_column(F.col(name), fields[name], target)
        for name, target in types.items()
        if name in fields
    }
    return df.withColumns(exprs) if exprs else df
