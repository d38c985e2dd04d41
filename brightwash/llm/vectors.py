"""Near-duplicate vectors through binary codes learned by iterative quantisation.

A rotation of the principal axes is learned that makes the signs of the
rotated coordinates lose least (Gong and Lazebnik's ITQ); the signs are a
vector's code. Vectors whose cosine reaches the threshold have codes within a
radius r that is measured on a sample: the smallest radius that holds the
stated share of pairs exactly at the threshold. Retrieval is by multi-index
hashing: codes are cut into substrings, and two codes within r differ by at
most r / substrings in one of them, so each is posted under all values within
half of that distance, where the two meet. Candidates within r are reranked
by the cosine of the original vectors in double precision.

Equal vectors of a label are one class and are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared, written
from .components import components

MOST_BITS = 64


class ITQ:
    """Codes of at most 64 bits for vectors of one length."""

    def __init__(self, sample: np.ndarray, threshold: float, recall: float, rounds: int = 50, seed: int = 5):
        random = np.random.default_rng(seed)
        every = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        # the radius is measured on vectors that the rotation was not fitted to
        cut = len(every) * 4 // 5 if len(every) >= 100 else len(every)
        unit, aside = every[:cut], every[cut:] if cut < len(every) else every
        dim = unit.shape[1]
        self.bits = min(MOST_BITS, dim)
        self.mean = unit.mean(axis=0)
        _, axes = np.linalg.eigh((unit - self.mean).T @ (unit - self.mean))
        axes = axes[:, ::-1][:, : self.bits]
        projected = (unit - self.mean) @ axes
        rotation = np.linalg.qr(random.standard_normal((self.bits, self.bits)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(projected.T @ np.where(projected @ rotation >= 0, 1.0, -1.0))
            rotation = u @ v
        self.turn = axes @ rotation
        self.radius = self._radius(np.resize(aside, (4000, dim)), threshold, recall, random)

    def _radius(self, unit: np.ndarray, threshold: float, recall: float, random: np.random.Generator) -> int:
        aside = random.standard_normal(unit.shape)
        aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
        norm = np.linalg.norm(aside, axis=1, keepdims=True)
        other = threshold * unit + math.sqrt(max(0.0, 1 - threshold**2)) * aside / np.where(norm > 0, norm, 1.0)
        apart = np.bitwise_count(self.codes(unit) ^ self.codes(other))
        return int(np.quantile(apart, recall, method="higher"))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        signs = (unit - self.mean) @ self.turn >= 0
        padded = np.zeros((len(signs), MOST_BITS), bool)
        padded[:, : self.bits] = signs
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)[:, 0]

    def tables(self, n: int) -> list[tuple[int, int, list[int]]]:
        """(shift, bits, masks) of each substring for ``n`` codes: substrings
        of about log2 n bits, and the values to post a code under."""
        count = max(1, self.bits // max(8, math.ceil(math.log2(max(2, n)))))
        edges = [self.bits * i // count for i in range(count + 1)]
        near = -(-(self.radius // count) // 2)
        out = []
        for a, b in zip(edges, edges[1:]):
            masks = [sum(1 << i for i in c) for k in range(near + 1) for c in combinations(range(b - a), k)]
            out.append((a, b - a, masks))
        return out


def _usable(vector: str, label: str) -> Column:
    """Vectors that can have a cosine: no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0) & F.col(label).isNotNull(), F.lit(False))


def _scaled(vector: Column) -> Column:
    """The vector divided by a power of two near its largest component, which
    rounds nothing and leaves every cosine as it is: products of the result
    neither overflow nor all vanish."""
    power = F.floor(F.log2(F.array_max(F.transform(vector, lambda x: F.abs(x)))))
    half = F.floor(power / 2)  # two factors: 2**-1074 has no finite inverse
    two = F.lit(2.0)
    factors = F.struct(F.pow(two, half.cast("double")).alias("p"), F.pow(two, (power - half).cast("double")).alias("q"))
    # as the element of an array the factors are worked out once a vector
    return F.element_at(F.transform(F.array(factors), lambda f: F.transform(vector, lambda x: x / f["p"] / f["q"])), 1)


def _cosine(a: str, b: str) -> Column:
    total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return total(a, b) / (F.sqrt(total(a, a)) * F.sqrt(total(b, b)))


def _links(classes: DataFrame, threshold: float, recall: float, sample_rows: int) -> DataFrame:
    """(a, b, cosine) for linked classes (node, label, vector)."""
    spark = classes.sparkSession
    sizes = {r["dim"]: r["n"] for r in classes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).collect()}
    models, tables = {}, {}
    for dim, n in sizes.items():
        # a bounded sample, drawn by hash
        share = min(1.0, sample_rows / n)
        drawn = classes.filter((F.size("vector") == dim) & (F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < share * (1 << 30)))
        rows = drawn.select("vector").toArrow().column(0).combine_chunks()
        sample = np.asarray(rows.flatten()).reshape(-1, dim) if len(rows) else np.eye(dim)
        models[dim] = ITQ(sample, threshold, recall)
        tables[dim] = models[dim].tables(n)
    shared = Shared(spark, (models, tables))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, tables = shared.get()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                node, label = part.column(0).to_numpy(), part.column(1).to_numpy(zero_copy_only=False)
                vectors = part.column(2)
                lengths = np.asarray(pa.compute.list_value_length(vectors))
                for dim, model in models.items():
                    own = np.flatnonzero(lengths == dim)
                    if not len(own):
                        continue
                    code = model.codes(np.asarray(vectors.take(pa.array(own)).flatten()).reshape(-1, dim))
                    for i, (shift, bits, masks) in enumerate(tables[dim]):
                        part_code = (code >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
                        key = (part_code[:, None] ^ np.array(masks, np.uint64)[None]).ravel().view(np.int64)
                        times = len(masks)
                        columns = [np.full(len(key), dim, np.int32), np.full(len(key), i, np.int32), key]
                        columns += [np.repeat(x[own], times) for x in (label, node)] + [np.repeat(code.view(np.int64), times)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "part", "key", "label", "node", "code"])

    posted = written(
        classes.select("node", "label", "vector").mapInArrow(post, "dim int, part int, key long, label long, node long, code long"),
        "postings",
    )
    on = ["dim", "part", "key", "label"]
    left = posted.withColumnsRenamed({"node": "a", "code": "ca"})
    right = posted.withColumnsRenamed({"node": "b", "code": "cb"})
    radius = F.create_map(*[x for d, m in models.items() for x in (F.lit(d), F.lit(m.radius))])
    near = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= F.element_at(radius, F.col("dim"))
    pairs = written(left.join(right, on).filter(F.col("a") < F.col("b")).filter(near).select("a", "b").distinct(), "pairs")
    vector = classes.select("node", "vector")
    both = pairs.join(vector.withColumnsRenamed({"node": "a", "vector": "va"}), "a")
    both = both.join(vector.withColumnsRenamed({"node": "b", "vector": "vb"}), "b")
    return both.select("a", "b", _cosine("va", "vb").alias("cosine")).filter(F.col("cosine") >= threshold)


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    recall: float = 0.999,
    sample_rows: int = 20_000,
) -> DataFrame:
    """(id, n_links, component_id, kept): one row per vector.

    Two vectors of the same non-null label and length are linked if their
    cosine is at least ``threshold``; ``recall`` is the share of pairs exactly
    at the threshold that retrieval keeps (of closer ones it keeps more).
    Vectors that are null, empty or zero or hold null or non-finite components
    link with nothing and are their own component; magnitudes do not matter
    (1e200 and 1e-200 alike). ``component_id`` is the
    smallest id of the component, null ids aside; ``kept`` marks it (false for
    a null id). Repeated rows link to each other. The quantiser is fitted on
    about ``sample_rows`` vectors of each length; every vector is indexed.
    """
    base = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    usable = _usable("vector", "label")
    base = base.withColumn("vector", F.when(usable, _scaled(F.col("vector"))).otherwise(F.col("vector")))
    classes = base.filter(usable).groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    if classes.isEmpty():
        named = classes.select("label", "vector", "copies", F.lit(0).cast("long").alias("others"), F.col("least").alias("component_id"))
    else:
        links = written(_links(classes, threshold, recall, sample_rows).select("a", "b"), "links")
        copies = classes.select("node", "copies")
        both = links.union(links.select("b", "a")).join(copies.withColumnRenamed("node", "b"), "b")
        others = both.groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "node")
        comp = classes.join(components(links, "a", "b"), "node", "left").withColumn("root", F.coalesce("component", "node"))
        comp = written(comp.select("node", "label", "vector", "copies", "least", "root"), "vector_components")
        smallest = comp.groupBy("root").agg(F.min("least").alias("component_id"))
        named = comp.join(smallest, "root").join(others, "node", "left").select("label", "vector", "copies", "others", "component_id")
    found = base.filter(usable).join(named, ["label", "vector"]).select(
        "id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    alone = base.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.union(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
