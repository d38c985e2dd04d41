"""Exact quantiles against brute force, including ties, skew and tiny bins."""

import math
import random

import pytest

from brightwash.operators.quantiles import (
    RankSelector,
    exact_quantiles,
    target_rank,
)

PROBS = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


def brute(values, q):
    vals = sorted(v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v)))
    if not vals:
        return None
    return vals[target_rank(q, len(vals)) - 1]


def test_target_rank_exact_arithmetic():
    # 0.07 * 100 is 7.000000000000001 in floating point; the rank must be 7
    assert target_rank(0.07, 100) == 7
    assert target_rank(0.5, 101) == 51
    assert target_rank(0.0, 10) == 1
    assert target_rank(1.0, 10) == 10


@pytest.mark.parametrize(
    "name,values",
    [
        ("uniform", [random.Random(1).uniform(-1e6, 1e6) for _ in range(3000)]),
        ("ties", [float(random.Random(2).randint(0, 20)) for _ in range(3000)]),
        # a third of all rows hold one value (hot value)
        ("hot", [42.0] * 1000 + [random.Random(3).gauss(0, 1e3) for _ in range(2000)]),
        ("clumped", [1e-9 * i for i in range(500)] + [1e9 + i for i in range(500)]),
        ("single", [7.5] * 10),
        ("with_nulls_nan", [None, float("nan"), 3.0, 1.0, 2.0, None]),
    ],
)
def test_exact_matches_brute_force(spark, name, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    # tiny bins and exact threshold force several refinement passes
    got = exact_quantiles(df, "v", PROBS, bins=8)
    assert got == [brute(values, q) for q in PROBS]


def test_exact_on_long_column(spark):
    values = [random.Random(4).randint(-(10**12), 10**12) for _ in range(2000)] + [5] * 700
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert exact_quantiles(df, "v", PROBS, bins=16) == [brute(values, q) for q in PROBS]


def test_empty_column(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, "v", [0.5]) == [None]


def test_trimmed_quantile_reuses_passes(spark):
    rnd = random.Random(5)
    values = [float(rnd.randint(0, 500)) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sel = RankSelector(df, "v", bins=8)
    p1, p99 = sel.quantiles([0.01, 0.99])
    kept = [v for v in values if p1 <= v <= p99]
    assert sel.count_below(p1) == sum(v < p1 for v in values)
    assert sel.count_at_most(p99) == sum(v <= p99 for v in values)
    assert sel.trimmed_quantile(p1, p99, 0.5) == brute(kept, 0.5)


def test_materialized_values_give_same_result_and_are_released(spark):
    values = [float(i % 97) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sel = RankSelector(df, "v", materialize=True)
    path = sel._materialized
    assert sel.quantiles(PROBS) == [brute(values, q) for q in PROBS]
    sel.release()
    assert spark.read.parquet(path).count() == 0


def test_trimmed_speculation_matches_brute_force_and_saves_passes(spark):
    rnd = random.Random(7)
    values = [round(rnd.lognormvariate(10, 1), 1) for _ in range(20000)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    probs = [0.01, 0.05, 0.95, 0.99]
    sel = RankSelector(df, "v", bins=64)
    got, median = sel.trimmed(probs, 0.01, 0.99, 0.5)
    assert got == [brute(values, q) for q in probs]
    kept = [v for v in values if v is not None and got[0] <= v <= got[-1]]
    assert median == brute(kept, 0.5)
    plain = RankSelector(df, "v", bins=64)
    p_low, p_high = plain.quantiles([0.01, 0.99])
    plain.trimmed_quantile(p_low, p_high, 0.5)
    assert sel.passes <= plain.passes


def test_non_numeric_column_is_rejected(spark):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(TypeError):
        exact_quantiles(df, "v", [0.5])


def test_few_distinct_values_need_one_pass(spark):
    # 50,000 rows, 300 distinct prices: each in a bucket of its own
    values = [float(i % 300) * 10.0 + 0.5 for i in range(50000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    sel = RankSelector(df, "v")
    assert sel.quantiles(PROBS) == [brute(values, q) for q in PROBS]
    assert sel.passes <= 2


def test_integers_and_decimals_beyond_double_precision(spark):
    from decimal import Decimal

    values = [1, 2**53, 2**53 + 1, 2**53 + 2, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    probs = [i / 6 for i in range(7)]
    assert exact_quantiles(df, "v", probs) == [brute(values, q) for q in probs]
    assert exact_quantiles(df, "v", probs, bins=2) == [brute(values, q) for q in probs]
    tens = [Decimal(v).scaleb(-3) for v in values]
    df = spark.createDataFrame([(v,) for v in tens], "v decimal(25,3)")
    assert exact_quantiles(df, "v", probs, bins=3) == [brute(tens, q) for q in probs]


@pytest.mark.parametrize("name", ["powers", "log_spread", "negative", "around_zero"])
def test_wide_spreads_take_few_passes(spark, name):
    rnd = random.Random(12)
    values = {
        "powers": [2.0**e for e in range(-1074, 1023)],
        "log_spread": [10 ** rnd.uniform(0, 30) for _ in range(45000)],
        "negative": [-(10 ** rnd.uniform(-20, 20)) for _ in range(5000)],
        "around_zero": [rnd.choice([-1, 0, 1]) * 2.0 ** rnd.randint(-1000, 1000) for _ in range(5000)],
    }[name]
    sel = RankSelector(spark.createDataFrame([(v,) for v in values], "v double").repartition(4), "v")
    assert sel.quantiles(PROBS) == [brute(values, q) for q in PROBS]
    assert sel.passes <= 3


def test_table_counts_from_the_selector(spark):
    from brightwash.operators.quantiles import quantile_table

    df = spark.createDataFrame([(v,) for v in [5, None, 1, 9]], "v bigint")
    assert quantile_table(df, "v", [0.5], ["m"]).collect() == [(3, 5)]
    with pytest.raises(ValueError):
        quantile_table(df, "v", [0.5], ["m"], method="sketch", accuracy=100_000)


def test_infinite_and_extreme_values(spark):
    inf = float("inf")
    values = [-inf, -inf, -1e308, -5.0, 0.0, 3.0, 7.5, 1e308, 1e308, inf] + [float(i) for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert exact_quantiles(df, "v", PROBS, bins=4) == [brute(values, q) for q in PROBS]


def test_sketch_quantiles_within_rank_error(spark):
    import bisect

    from brightwash.operators.quantiles import sketch_quantile_row

    rnd = random.Random(8)
    values = [rnd.lognormvariate(10, 1) for _ in range(50000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(16)
    probs = [0.01, 0.05, 0.5, 0.95, 0.99]
    row = sketch_quantile_row(df, "v", probs, k=4096, fan_in=4, names=["a", "b", "c", "d", "e"]).first()
    ordered = sorted(values)
    for q, got in zip(probs, row):
        rank = bisect.bisect_right(ordered, got) / len(ordered)
        assert abs(rank - q) < 0.005, (q, rank)
    empty = spark.createDataFrame([], "v double")
    assert sketch_quantile_row(empty, "v", [0.5], names=["m"]).first().m is None


@pytest.mark.parametrize("column,max_passes", [("l_extendedprice", 3), ("l_quantity", 1)])
def test_exact_matches_duckdb_on_lineitem(spark, column, max_passes):
    import duckdb

    from conftest import SF01

    path = f"{SF01}/lineitem.parquet"
    probs = [0.01, 0.05, 0.5, 0.95, 0.99]
    sel = RankSelector(spark.read.parquet(path), column, materialize=True)
    got = sel.quantiles(probs)
    sel.release()
    sql = ", ".join(f"quantile_disc({column}, {q})" for q in probs)
    assert got == list(duckdb.sql(f"SELECT {sql} FROM '{path}'").fetchall()[0])
    assert sel.passes <= max_passes


def test_sketch_within_its_rank_error_on_lineitem(spark):
    import bisect

    from conftest import SF01

    from brightwash.operators.quantiles import sketch_quantile_row

    df = spark.read.parquet(f"{SF01}/lineitem.parquet")
    values = sorted(r[0] for r in df.select("l_extendedprice").collect())
    n = len(values)
    probs = [0.01, 0.05, 0.5, 0.95, 0.99]
    names = [f"q{i}" for i in range(len(probs))]
    sketch = sketch_quantile_row(df.repartition(8), "l_extendedprice", probs, k=4096, names=names).first()
    for q, name in zip(probs, names):
        rank = bisect.bisect_right(values, sketch[name]) / n
        assert abs(rank - q) < 0.005, (q, rank)
