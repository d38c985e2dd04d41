import math
import random

import numpy as np

from brightwash.llm import vectors
from test_simhash import brute_components

SCHEMA = "vec_id long, embedding array<float>, label int"


def near(rng, base, cosine):
    aside = rng.standard_normal(len(base))
    aside -= aside @ base * base
    return cosine * base + math.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for group in range(40):
        base = rng.standard_normal(32)
        base /= np.linalg.norm(base)
        label = int(rng.integers(0, 3))
        for c in rng.uniform(0.97, 1.0, rng.integers(1, 6)):
            rows.append(((near(rng, base, c) * rng.uniform(0.5, 2)).astype(np.float32).tolist(), label))
    rows += [rows[0], rows[0], (rows[0][0], 9), (rows[0][0], None)]  # copies; another label; none
    rows += [([0.0] * 32, 1), (None, 1), ([math.nan] + [1.0] * 31, 1), ([None] + [1.0] * 31, 1), ([math.inf] * 32, 1), ([], 1)]
    rows += [([1.0, 0.0], 1), ([1.0, 1e-3], 1)]  # another length
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(i, v, g) for i, (v, g) in enumerate(rows)], SCHEMA)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(table).collect()}
    good = {
        i: np.array(v, float) for i, (v, g) in enumerate(rows)
        if v and g is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    links = [
        (a, b) for a in good for b in good
        if a < b and rows[a][1] == rows[b][1] and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.98
    ]
    label = brute_components(range(len(rows)), links)
    assert len(links) > 40
    assert found == {i: (sum(i in e for e in links), label[i], label[i] == i) for i in range(len(rows))}


def test_null_ids_and_empty_table(spark):
    same = [1.0, 2.0, 3.0, 4.0] * 4
    table = spark.createDataFrame([(None, same, 1), (8, same, 1), (None, [5.0] + same[1:], 2)], SCHEMA)
    found = sorted(((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in vectors.near_duplicates(table).collect()))
    assert found == [(-1, 0, -1, False), (-1, 1, 8, False), (8, 1, 8, True)]
    assert vectors.near_duplicates(table.limit(0)).collect() == []


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    sample = rng.standard_normal((2000, 64))
    model = vectors.ITQ(sample, 0.98, 0.999)
    unit = rng.standard_normal((2000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    other = np.array([near(rng, u, 0.98) for u in unit])
    apart = np.bitwise_count(model.codes(unit) ^ model.codes(other))
    assert (apart <= model.radius).mean() >= 0.99
    # any two codes within the radius share a posted value of a substring
    for shift, bits, masks in model.tables(10_000):
        assert 0 in masks and max(masks) < 1 << bits


def test_magnitudes_do_not_matter(spark):
    """Products of these components overflow or vanish; the cosines are ordinary."""
    rng = np.random.default_rng(4)
    rows, plain = [], []
    for i in range(60):
        base = rng.standard_normal(16)
        base /= np.linalg.norm(base)
        for c in (1.0, 0.99, 0.975):
            plain.append(near(rng, base, c))
            rows.append((plain[-1] * 10.0 ** rng.choice([-300, -200, -5, 0, 9, 200, 300])).tolist())
    pairs = [[1e200, 1e200], [1e200, 0.0], [1e-200, 0.0], [5e-324, 0.0], [1.7e308, 1.7e308], [-1e-320, 0.0]]
    for v in pairs:
        rows.append(v)
        plain.append(np.array(v) / max(abs(x) for x in v))
    table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(table).collect()}
    unit = [v / np.linalg.norm(v) for v in plain]
    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    label = brute_components(range(len(rows)), links)
    assert {(180, 184), (181, 182), (181, 183), (182, 183)} <= set(links) and (180, 181) not in links
    assert found == {i: (sum(i in e for e in links), label[i], label[i] == i) for i in range(len(rows))}
