"""Column expressions on tiny literal frames (NULL, '', 'NULL', junk, NaN, overflow)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightwash.config import Box
from brightwash.functions import (
    clean_price_text,
    convert_column,
    in_box,
    null_or_between,
    outside_box,
    price_band,
    text_to_integral,
)
from brightwash.functions.predicates import is_missing_text


def _one_col(spark, values, ddl="s string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_price_text(spark):
    inputs = ["$1,234.50", "CLP .75", "1.2.3", "-50", "", "NULL", "gratis", None, "$37648.50"]
    expected = [1234.5, 0.75, None, 50.0, None, None, None, None, 37648.5]
    df = _one_col(spark, inputs).select(clean_price_text(F.col("s")).alias("p"))
    assert [r.p for r in df.collect()] == expected


def test_text_to_long_truncates_and_never_fails(spark):
    inputs = ["12", "", "NULL", "abc", "3.7", "-3.7", " 5 ", "12345678901", None, "9" * 30]
    expected = [12, None, None, None, 3, -3, 5, 12345678901, None, None]
    df = _one_col(spark, inputs).select(
        convert_column(F.col("s"), _one_col(spark, []).schema["s"].dataType, "bigint").alias("x")
    )
    assert [r.x for r in df.collect()] == expected


def test_text_to_int_overflow_is_null_not_wrapped(spark):
    df = _one_col(spark, ["12345678901", "2147483647"]).select(text_to_integral(F.col("s"), "int").alias("x"))
    assert [r.x for r in df.collect()] == [None, 2147483647]


def test_numeric_narrowing_is_null_on_overflow(spark):
    df = spark.createDataFrame([(12345678901,), (7,)], "v bigint")
    out = df.select(convert_column(F.col("v"), df.schema["v"].dataType, "int").alias("x"))
    assert [r.x for r in out.collect()] == [None, 7]


def test_text_to_double_and_date(spark):
    schema = _one_col(spark, []).schema["s"].dataType
    df = _one_col(spark, ["-33.5", "", "NULL", "x", None, "2020-02-29", "2021-02-30"])
    out = df.select(
        convert_column(F.col("s"), schema, "double").alias("d"),
        convert_column(F.col("s"), schema, "date").alias("dt"),
    ).collect()
    assert [r.d for r in out] == [-33.5, None, None, None, None, None, None]
    assert [str(r.dt) if r.dt else None for r in out] == [None] * 5 + ["2020-02-29", None]


def test_missing_text_sentinels(spark):
    df = _one_col(spark, ["", "NULL", None, "null", " "]).select(is_missing_text(F.col("s")).alias("m"))
    assert [r.m for r in df.collect()] == [True, True, True, False, False]


def test_box_predicates_three_valued(spark):
    box = Box()
    rows = [(-33.5, -70.5), (-34.0, -70.5), (None, -71.5), (None, -70.5), (-33.8, -70.2), (float("nan"), -70.5)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    out = df.select(in_box(box).alias("inside"), outside_box(box).alias("outside")).collect()
    assert [r.inside for r in out] == [True, False, False, None, True, False]
    # NaN compares greater than any number, so it is out of range
    assert [r.outside for r in out] == [False, True, True, None, False, True]


def test_null_or_between(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,), (9.0,)], "v double")
    out = df.filter(null_or_between(F.col("v"), F.lit(1.0), F.lit(5.0)))
    assert sorted([r.v for r in out.collect()], key=lambda x: (x is not None, x)) == [None, 1.0, 5.0]


def test_price_band_null_goes_to_last_band(spark):
    df = spark.createDataFrame([(1.0,), (30000.0,), (59999.9,), (60000.0,), (100000.0,), (None,)], "price double")
    out = [r.b for r in df.select(price_band(F.col("price")).alias("b")).collect()]
    assert out == [
        "Económico (<30k)",
        "Moderado (30k-60k)",
        "Moderado (30k-60k)",
        "Caro (60k-100k)",
        "Premium (>100k)",
        "Premium (>100k)",
    ]


def test_nan_is_not_missing_in_fills(spark):
    from brightwash.operators.fill import drop_missing, fill_constants

    df = spark.createDataFrame([(float("nan"), 1), (None, None)], "r double, m int")
    filled = fill_constants(df, {"r": 0.0, "m": 1})
    rows = filled.collect()
    assert math.isnan(rows[0].r) and rows[1].r == 0.0 and rows[1].m == 1
    assert dict(filled.dtypes)["m"] == "int"
    assert drop_missing(df, ("r",)).count() == 1


def _python_price(text):
    """Plain-Python statement of the price rule, for comparison."""
    if text is None or text in ("", "NULL"):
        return None
    kept = "".join(ch for ch in text if ch.isascii() and (ch.isdigit() or ch == "."))
    if kept.startswith("."):
        kept = "0" + kept
    try:
        return float(kept)
    except ValueError:
        return None


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789.,$ -abcNUL€", max_size=12)), min_size=200, max_size=200))
def test_price_text_matches_rule_on_random_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(
        F.col("s"), clean_price_text(F.col("s")).alias("p")
    )
    got = [(r.s, r.p) for r in df.collect()]
    assert got == [(t, _python_price(t)) for t in texts]


def _python_integral(text):
    """Plain-Python statement of the text -> int rule (truncate toward zero)."""
    from decimal import Decimal, InvalidOperation

    if text is None or text in ("", "NULL"):
        return None
    try:
        value = int(Decimal(text.strip()))  # int() of a Decimal truncates toward zero
    except (InvalidOperation, ValueError):
        return None
    return value if -(2**31) <= value < 2**31 else None


_number_text = st.builds(
    lambda pad1, sign, whole, frac, pad2: f"{pad1}{sign}{whole}{frac}{pad2}",
    st.sampled_from(["", " "]),
    st.sampled_from(["", "-", "+"]),
    st.text(alphabet="0123456789", min_size=1, max_size=12),
    st.one_of(st.just(""), st.text(alphabet="0123456789", min_size=1, max_size=4).map(lambda d: "." + d)),
    st.sampled_from(["", " "]),
)


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.one_of(_number_text, st.sampled_from(["", "NULL", "x", "3.7.1"])), min_size=200, max_size=200))
def test_text_to_int_matches_rule_on_random_numbers(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = df.select(convert_column(F.col("s"), df.schema["s"].dataType, "int").alias("x")).collect()
    assert [r.x for r in out] == [_python_integral(t) for t in texts]
