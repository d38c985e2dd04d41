"""Column types of text tables by one pass, with quarantine of misfits.

Each value has one outcome: missing, or the narrowest type that it reads as.
Types form a lattice: ``int`` below ``bigint`` below ``double``, ``date`` below
``timestamp``, ``boolean`` alone, and ``string`` above all. A column's state is
the number of values of each outcome; states of parts of a table (files,
partitions, days) add up, so a state can be stored and merged with later ones.
From the state follows the column's type: the lowest type of the lattice above
which at most a stated share of the values lies. Those values are the misfits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwash.config import MISSING_TEXT

# The outcomes, each with the outcomes whose values it can hold.
# Lower types come first; the first one that fits is taken.
HOLDS: dict[str, tuple[str, ...]] = {
    "boolean": ("boolean",),
    "int": ("int",),
    "bigint": ("int", "bigint"),
    "double": ("int", "bigint", "double"),
    "date": ("date",),
    "timestamp": ("date", "timestamp"),
    "string": ("boolean", "int", "bigint", "double", "date", "timestamp", "string"),
}
OUTCOMES = tuple(HOLDS)
_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


def is_missing(value: Column) -> Column:
    return value.isNull() | value.isin(*MISSING_TEXT)


def outcome(value: Column) -> Column:
    """The narrowest type of the lattice that a text reads as; NULL if missing."""
    whole = value.rlike(r"^[+-]?[0-9]+$")
    return (
        F.when(is_missing(value), F.lit(None))
        .when(F.lower(value).isin("true", "false"), "boolean")
        .when(whole & value.try_cast("int").isNotNull(), "int")
        .when(whole & value.try_cast("bigint").isNotNull(), "bigint")
        .when(value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "double")
        .when(value.rlike(f"^{_DAY}$") & value.try_cast("date").isNotNull(), "date")
        .when(value.rlike(f"^{_DAY}[ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]+)?)?$") & value.try_cast("timestamp_ntz").isNotNull(), "timestamp")
        .otherwise("string")
    )


def type_states(df: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    """(position, column, outcome, n): the state of every text column, and the
    malformed rows under the outcome ``corrupt``; one aggregate, one pass.

    Malformed rows (``corrupt_column`` not NULL) tell nothing about types, as
    their fields may be shifted.
    """
    columns = [c for c in df.columns if c != corrupt_column]
    whole = F.lit(True) if corrupt_column is None else F.col(corrupt_column).isNull()
    coded = df.select(whole.alias("whole"), *[F.when(whole, outcome(F.col(f"`{c}`"))).alias(f"o{i}") for i, c in enumerate(columns)])
    counts = [F.count_if(F.col(f"o{i}") == kind).alias(f"n{i}_{kind}") for i in range(len(columns)) for kind in OUTCOMES]
    row = coded.agg(F.count_if(~F.col("whole")).alias("corrupt"), *counts)
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(kind).alias("outcome"), F.col(f"n{i}_{kind}").alias("n"))
        for i, c in enumerate(columns)
        for kind in OUTCOMES
    ]
    rows.append(F.struct(F.lit(-1).alias("position"), F.lit(None).cast("string").alias("column"), F.lit("corrupt").alias("outcome"), F.col("corrupt").alias("n")))
    return row.select(F.inline(F.array(*rows)))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows from the states of its parts."""
    every = reduce(DataFrame.unionByName, states)
    return every.groupBy("position", "column", "outcome").agg(F.sum("n").alias("n"))


def infer_types(states: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(position, column, type, filled, misfits, corrupt_rows) from a state.

    ``type`` is the lowest type that all but ``tolerance`` of the ``filled``
    (not missing) values read as; a column without values is ``string``.
    """
    by_column = states.groupBy("position", "column").agg(
        F.sum("n").alias("filled"),
        *[F.coalesce(F.sum(F.when(F.col("outcome").isin(*below), F.col("n"))), F.lit(0)).alias(f"fit_{kind}") for kind, below in HOLDS.items()],
    )
    fits = lambda kind: F.col("filled") - F.col(f"fit_{kind}") <= tolerance * F.col("filled")
    choice = F.when(F.col("filled") == 0, "string")
    misfits = F.when(F.col("filled") == 0, F.lit(0).cast("long"))
    for kind in HOLDS:
        choice = choice.when(fits(kind), kind)
        misfits = misfits.when(fits(kind), F.col("filled") - F.col(f"fit_{kind}"))
    broken = states.filter("outcome = 'corrupt'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return by_column.filter("position >= 0").select(
        "position", "column", choice.alias("type"), "filled", misfits.alias("misfits"), broken.scalar().alias("corrupt_rows")
    )


@dataclass(frozen=True)
class Inferred:
    """A typed table, the rows that did not fit, and the types."""

    typed: DataFrame
    quarantine: DataFrame
    types: dict[str, str]


def apply_types(df: DataFrame, types: dict[str, str], corrupt_column: str | None = None, carry: tuple[str, ...] = ()) -> Inferred:
    """Split ``df`` into typed rows and quarantined ones.

    A row goes to quarantine if it is malformed or a value is a misfit of its
    column's type: as (``carry`` columns, column, value), one row per misfit, and
    for a malformed row one with its text under the column NULL. Typed rows
    hold NULL for missing values. Both are lazy filters over one source.
    """
    columns = [c for c in df.columns if c != corrupt_column]
    value = {c: F.col(f"`{c}`") for c in columns}
    misfit = {c: ~is_missing(value[c]) & ~outcome(value[c]).isin(*HOLDS[types[c]]) for c in columns if types[c] != "string"}
    bad = [F.when(test, F.struct(F.lit(c).alias("column"), value[c].alias("value"))) for c, test in misfit.items()]
    none = F.array().cast("array<struct<column:string,value:string>>")
    found = F.filter(F.array(*bad), lambda m: m.isNotNull()) if bad else none
    if corrupt_column is not None:
        broken = F.col(corrupt_column)
        whole = F.array(F.struct(F.lit(None).cast("string").alias("column"), broken.alias("value")))
        found = F.when(broken.isNotNull(), whole).otherwise(found)
    mark = "misfits"
    while mark in df.columns:  # any other column keeps its name
        mark += "_"
    marked = df.withColumn(mark, found)
    typed = marked.filter(F.size(mark) == 0).select(
        *[F.when(~is_missing(value[c]), value[c].try_cast("timestamp_ntz" if types[c] == "timestamp" else types[c])).alias(c) for c in columns]
    )
    quarantine = marked.select(*carry, F.inline(mark))
    return Inferred(typed, quarantine, types)


def inferred_types(states: DataFrame, tolerance: float = 0.0) -> dict[str, str]:
    """Column to type, one small row per column collected."""
    return {row["column"]: row["type"] for row in infer_types(states, tolerance).orderBy("position").collect()}
