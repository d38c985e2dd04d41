"""Quantiles of one column: exact (distributed refinement) or approximate.

Definition (both methods): the q-quantile of n non-NULL values is the value
of rank ``max(1, ceil(q * n))`` in ascending order - the smallest value
whose cumulative share reaches q. It is always an element of the column.

``exact_quantiles`` never sorts the data and never moves a group of rows to
one task. Each pass is one aggregation with map-side combine:

1. ``count, min, max`` of the column (observed during the write when the
   column is materialized, so no pass of its own).
2. For every rank still open, the value range known to contain it is split
   into ``bins`` buckets; ``groupBy(range, bucket).agg(count, min, max)`` gives
   a histogram of at most ``bins`` rows per open range. The bucket holding
   the rank becomes the new range (its own min and max). A range whose min is
   its max is the answer.

Buckets are computed in the column's own type. Integral and decimal values
are divided exactly, so the range shrinks ``bins``-fold per pass. Doubles are
split evenly in logarithms while the range spans several powers of two, else
evenly in value: one pass parts the powers of two, after that at most 52
bits are left. The least and the greatest value of a range always fall into
different buckets, so every pass shrinks every open range and no limit on
passes is needed; two or three are usual.

Only histograms (bounded by ``bins`` rows per rank) reach the driver. A
value repeated in a third of all rows is one histogram row, not a hot task.

``sketch_quantile_columns`` keeps the quantile inside the plan instead:
mergeable KLL sketches, combined as a two-level tree, give one row that later
filters read as a scalar subquery (lazy, no driver round trip); the last step
stays small however many map tasks there are.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

from brightwash.session import scratch_dir


def target_rank(q: float, n: int) -> int:
    """1-based rank of the q-quantile among n values, in exact arithmetic."""
    if not 0.0 <= q <= 1.0:
        raise ValueError(f"quantile {q} outside [0, 1]")
    return max(1, math.ceil(Fraction(str(q)) * n))


def _values(df: DataFrame, column: str) -> DataFrame:
    if not isinstance(df.schema[column].dataType, NumericType):
        raise TypeError(f"quantiles need a numeric column, {column} is {df.schema[column].dataType}")
    v = F.col(column)
    keep = v.isNotNull()
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        keep = keep & ~F.isnan(v)
    return df.select(v.alias("v")).filter(keep)


class RankSelector:
    """Exact order statistics of one column by histogram refinement.

    Pass 1 counts the values and finds their range. Each later pass is one
    ``groupBy(range, bucket).agg(count, min, max)`` for all still-open
    ranks at once (see module doc). Histograms are kept, so a later rank
    (e.g. a median that depends on earlier quantiles) descends the cached
    tree first and only scans the data below the deepest cached level.

    ``materialize=True`` first writes the values (one column) as Parquet to
    the shared checkpoint folder, so the passes read that small table
    instead of recomputing an expensive source (CSV parsing, joins).
    """

    def __init__(
        self,
        df: DataFrame,
        column: str,
        bins: int = 4096,
        materialize: bool = False,
    ):
        if bins < 2:
            raise ValueError("a range needs at least two buckets")
        values = _values(df, column)
        self._materialized = None
        stats_cols = [
            F.count(F.lit(1)).alias("n"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
        ]
        if materialize:
            # count / min / max are observed while writing: no extra pass
            path = scratch_dir(df.sparkSession, "quantile-values")
            obs = Observation("quantile-values")
            values.observe(obs, *stats_cols).write.mode("overwrite").parquet(path)
            stats = obs.get
            values = df.sparkSession.read.schema(values.schema).parquet(path)
            self._materialized = path
        else:
            stats = values.agg(*stats_cols).first()
        self.values = values
        self.bins = bins
        self.type = values.schema["v"].dataType
        self.n = int(stats["n"])
        # a range: (lo, hi, values below lo, values in range)
        self.root = (stats["lo"], stats["hi"], 0, self.n)
        # range -> sorted buckets [(n, lo, hi)]; value -> (count below, count equal)
        self._hist: dict[tuple, list[tuple]] = {}
        self._found: dict[object, tuple[int, int]] = {}
        self.passes = 0

    def release(self) -> None:
        """Drop the materialized values from the shared folder.

        Overwriting the table with an empty one removes its data files (the
        public API has no delete); the selector cannot scan afterwards.
        """
        if self._materialized:
            spark = self.values.sparkSession
            spark.createDataFrame([], self.values.schema).write.mode("overwrite").parquet(self._materialized)
            self._materialized = None
            self.values = None

    def _descend(self, r: int) -> tuple[str, object]:
        """Walk the cached histograms towards rank ``r``.

        Returns ``("found", value)`` or ``("open", range)`` for the deepest
        range that still has to be scanned.
        """
        state = self.root
        while True:
            lo, hi, below, cnt = state
            if lo == hi:
                self._found.setdefault(lo, (below, cnt))
                return "found", lo
            buckets = self._hist.get(state)
            if buckets is None:
                return "open", state
            seen = below
            for bn, blo, bhi in buckets:
                if seen + bn >= r:
                    if (blo, bhi) == (lo, hi):  # pragma: no cover - lo and hi have buckets of their own
                        raise RuntimeError("a pass did not shrink its range")
                    state = (blo, bhi, seen, bn)
                    break
                seen += bn
            else:  # pragma: no cover - counts always cover the rank
                raise RuntimeError("rank not covered by histogram")

    def _bucket(self, lo, hi) -> Column:
        """Bucket of ``v`` within ``[lo, hi]``: monotone in ``v``, and different
        for ``lo`` and ``hi``."""
        v = F.col("v")
        if isinstance(self.type, (DoubleType, FloatType)):
            return self._float_bucket(v.cast("double"), float(lo), float(hi))
        if isinstance(self.type, DecimalType):
            scale = self.type.scale
            steps = int((hi - lo).scaleb(scale))
            width = -(-(steps + 1) // self.bins)
            as_decimal = lambda x, p: f"cast('{x}' as decimal({p},{scale}))"
            unit = Decimal(width).scaleb(-scale)
            return F.expr(f"(v - {as_decimal(lo, self.type.precision)}) div {as_decimal(unit, 38)}").cast("double")
        width = -(-(hi - lo + 1) // self.bins)  # Python integers: exact beyond 2**53
        return F.expr(f"(cast(v as decimal(20,0)) - cast('{lo}' as decimal(20,0))) div cast('{width}' as decimal(20,0))").cast("double")

    def _float_bucket(self, x: Column, lo: float, hi: float) -> Column:
        if math.isinf(lo) or math.isinf(hi):  # infinite ends are split off first
            return F.when(x == lo, F.lit(0.0)).when(x == hi, F.lit(2.0)).otherwise(F.lit(1.0))
        small, large = sorted((abs(lo), abs(hi)))
        if lo * hi > 0 and large > 4 * small:
            # one sign: even in logarithms (the logarithm is monotone)
            place = F.log(F.abs(x)) if lo > 0 else -F.log(F.abs(x))
            ends = sorted((math.log(small), math.log(large)) if lo > 0 else (-math.log(small), -math.log(large)))
        elif lo * hi <= 0 and large > 1e-300:
            # around zero: logarithms to both sides, scaled so that zero's own
            # bucket is 2**1000 times smaller than the range
            factor = 2.0 ** min(1000 - math.frexp(large)[1], 1023)
            place = F.signum(x) * F.log1p(F.abs(x) * factor)
            ends = [math.copysign(math.log1p(abs(e) * factor), e) for e in (lo, hi)]
        else:
            # halved, so that finite extremes cannot overflow the width
            place, ends = x / 2, [lo / 2, hi / 2]
        width = ends[1] - ends[0]
        if width <= 0.0:  # a few units in the last place
            return F.when(x == lo, F.lit(0.0)).when(x == hi, F.lit(2.0)).otherwise(F.lit(1.0))
        inner = F.floor((place - ends[0]) / width * self.bins)
        inner = F.greatest(F.lit(0), F.least(inner, F.lit(self.bins - 1))).cast("double")
        # the ends keep buckets of their own whatever the rounding between
        return F.when(x == lo, F.lit(-1.0)).when(x == hi, F.lit(float(self.bins))).otherwise(inner)

    def _scan(self, ranges: list[tuple]) -> None:
        """One aggregation pass building the histogram of each open range."""
        v = F.col("v")
        range_id = key = None
        for i, (lo, hi, _, _) in enumerate(ranges):
            inside = v.between(F.lit(lo), F.lit(hi))
            k = self._bucket(lo, hi)
            range_id = F.when(inside, F.lit(i)) if range_id is None else range_id.when(inside, F.lit(i))
            key = F.when(inside, k) if key is None else key.when(inside, k)
        rows = (
            self.values.select(range_id.alias("rid"), key.alias("k"), "v")
            .filter(F.col("rid").isNotNull())
            .groupBy("rid", "k")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        for i, state in enumerate(ranges):
            mine = sorted((row["k"], int(row["n"]), row["lo"], row["hi"]) for row in rows if row["rid"] == i)
            self._hist[state] = [(bn, blo, bhi) for _, bn, blo, bhi in mine]

    def select(self, ranks: list[int], speculate=None) -> list:
        """Values at the 1-based ``ranks`` (each in ``1..n``).

        ``speculate`` (optional) is called before every pass and returns
        further ranks whose ranges should be refined in the same pass, e.g.
        the possible ranks of a quantile that depends on these ones.
        """
        for r in ranks:
            if not 1 <= r <= self.n:
                raise ValueError(f"rank {r} outside 1..{self.n}")
        while True:  # every pass shrinks every open range
            walks = [self._descend(r) for r in ranks]
            # Ranges of one pass are leaves of one tree level or of disjoint
            # subtrees, so they never overlap and a row belongs to at most one.
            open_ranges = {state for kind, state in walks if kind == "open"}
            if not open_ranges:
                return [value for _, value in walks]
            if speculate is not None:
                for r in speculate():
                    kind, state = self._descend(r)
                    if kind == "open":
                        open_ranges.add(state)
            self._scan(sorted(open_ranges))
            self.passes += 1

    def _rank_bounds(self, r: int) -> tuple[int, int, int, int]:
        """Known bounds of ``count(< x)`` and ``count(<= x)`` for the value x
        at rank ``r``: ``(lt_min, lt_max, le_min, le_max)``."""
        kind, state = self._descend(r)
        if kind == "found":
            below, equal = self._found[state]
            return below, below, below + equal, below + equal
        _, _, below, cnt = state
        return below, below + cnt - 1, below + 1, below + cnt

    def trimmed(self, probs, low_q: float, high_q: float, fill_q: float) -> tuple[list, object]:
        """Quantiles ``probs`` (which hold ``low_q`` and ``high_q``) and the
        ``fill_q``-quantile of the values within ``[q(low_q), q(high_q)]``.

        The trimmed quantile's rank among all values is bounded as soon as
        the trim bounds are narrowed to a bucket, so its ranges are refined
        in the same passes (usually no pass of its own).
        """
        if self.n == 0:
            return [None] * len(probs), None
        ranks = [target_rank(q, self.n) for q in probs]
        r_low, r_high = target_rank(low_q, self.n), target_rank(high_q, self.n)

        def speculate():
            lt_min, lt_max, _, _ = self._rank_bounds(r_low)
            _, _, le_min, le_max = self._rank_bounds(r_high)
            out = []
            for lt, le in ((lt_min, le_min), (lt_max, le_max)):
                if le > lt:
                    out.append(lt + target_rank(fill_q, le - lt))
            return out

        values = self.select(ranks, speculate)
        by_q = dict(zip(probs, values))
        return values, self.trimmed_quantile(by_q[low_q], by_q[high_q], fill_q)

    def quantiles(self, probs: list[float] | tuple[float, ...]) -> list:
        if self.n == 0:
            return [None] * len(probs)
        return self.select([target_rank(q, self.n) for q in probs])

    def count_below(self, value) -> int:
        """Values ``< value`` for a value returned by :meth:`select`."""
        return self._found[value][0]

    def count_at_most(self, value) -> int:
        """Values ``<= value`` for a value returned by :meth:`select`."""
        below, equal = self._found[value]
        return below + equal

    def trimmed_quantile(self, low_value, high_value, q: float):
        """q-quantile of the values within ``[low_value, high_value]``, both
        previously returned by :meth:`select`; reuses the cached passes."""
        first = self.count_below(low_value)
        inside = self.count_at_most(high_value) - first
        if inside <= 0:
            return None
        return self.select([first + target_rank(q, inside)])[0]


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: list[float] | tuple[float, ...],
    bins: int = 4096,
    materialize: bool = False,
) -> list:
    """Exact quantiles (see module doc). NULL and NaN are ignored;
    an empty column gives ``None`` for every quantile."""
    selector = RankSelector(df, column, bins, materialize=materialize)
    values = selector.quantiles(probs)
    selector.release()
    return values


def sketch_quantile_row(
    df: DataFrame,
    column: str,
    probs: list[float] | tuple[float, ...],
    k: int = 4096,
    fan_in: int = 1024,
    names: list[str] | None = None,
) -> DataFrame:
    """One row of approximate quantiles from KLL sketches merged as a tree.

    Every task builds one sketch of its rows (grouping by its partition id
    modulo ``fan_in``), ``fan_in`` reducers merge those, and one final task
    merges at most ``fan_in`` sketches, so the last step does not grow with
    the number of map tasks. ``k`` sets the sketch size; the normalized rank
    error is about ``2.3 / k ** 0.97`` (0.07 % at the default). NULL when empty.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    values = _values(df, column).select(F.col("v").cast("double").alias("v"))
    per_task = values.groupBy((F.spark_partition_id() % fan_in).alias("part")).agg(
        F.kll_sketch_agg_double("v", k).alias("sketch")
    )
    merged = per_task.agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    filled = F.kll_sketch_get_n_double("sketch") > 0  # an empty sketch has no quantile
    return merged.select(
        *[
            F.when(filled, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(name)
            for q, name in zip(probs, names)
        ]
    )


def sketch_quantile_columns(
    df: DataFrame,
    column: str,
    probs: list[float] | tuple[float, ...],
    k: int = 4096,
) -> list[Column]:
    """:func:`sketch_quantile_row` as scalar-subquery columns."""
    row = sketch_quantile_row(df, column, probs, k)
    return [row.select(name).scalar() for name in row.columns]


def quantile_values(
    df: DataFrame,
    column: str,
    probs: list[float] | tuple[float, ...],
    method: str = "exact",
    accuracy: int = 4096,
    materialize: bool = False,
) -> list:
    """Quantiles as literal columns (exact) or scalar subqueries (sketch);
    ``accuracy`` is the sketch's k (8 to 65535)."""
    if method == "exact":
        values = exact_quantiles(df, column, probs, materialize=materialize)
        return [F.lit(x).cast("double") for x in values]
    if method == "sketch":
        if not 8 <= accuracy <= 65535:
            raise ValueError(f"a sketch takes k from 8 to 65535, not {accuracy}")
        return [c.cast("double") for c in sketch_quantile_columns(df, column, probs, accuracy)]
    raise ValueError(f"unknown quantile method {method!r}")


def quantile_table(
    df: DataFrame,
    column: str,
    probs: list[float] | tuple[float, ...],
    names: list[str],
    method: str = "exact",
    accuracy: int = 4096,
    materialize: bool = False,
) -> DataFrame:
    """One row, one named column per quantile, plus ``n`` (values counted).

    The exact method returns the numbers it has found, in the column's own
    type; nothing is scanned again for the count.
    """
    if method == "exact":
        selector = RankSelector(df, column, materialize=materialize)
        values = selector.quantiles(probs)
        selector.release()
        kind = df.schema[column].dataType.simpleString()
        schema = "n long, " + ", ".join(f"`{name}` {kind}" for name in names)
        return df.sparkSession.createDataFrame([(selector.n, *values)], schema)
    cols = quantile_values(df, column, probs, method, accuracy)
    base = df.agg(F.count(column).alias("n"))
    return base.select("n", *[c.alias(name) for c, name in zip(cols, names)])
