import random

import numpy as np
import pytest
import xxhash

from brightwash.llm import simhash
from brightwash.llm.common import runs
from brightwash.llm.components import components
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_near_duplicates_equal_brute_force(make_docs, rng):
    texts = edge_texts(rng)
    for _ in range(6):
        base = prose(rng, 300).split()
        for _ in range(5):
            copy = list(base)
            copy[rng.randrange(300)] = "changed"
            texts.append(" ".join(copy))
    rows = simhash.near_duplicates(make_docs(texts, extra=CLASHING)).collect()
    assert len(rows) == len(texts)
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    label = brute_components(fps, pairs)
    assert {r.doc_id: r.fingerprint for r in rows} == {i: format(f, "016x") for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == label


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_equal_brute_force(spark, bits):
    random_bits = random.Random(bits)
    values = {random_bits.getrandbits(64) for _ in range(60)}
    for v in list(values)[:30]:
        for _ in range(6):
            w = v
            for _ in range(random_bits.randint(1, 3)):
                w ^= 1 << random_bits.randrange(64)
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits).collect()
    assert len(found) == len({frozenset((r.a, r.b)) for r in found})
    want = {
        frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits
    }
    assert {frozenset((r.a, r.b)) for r in found} == want


def test_more_bits_than_the_count_filter_guarantees(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_null_ids_and_empty_table(make_docs):
    rows = simhash.near_duplicates(make_docs(["a b c d"] * 3 + ["q r s"], ids=[None, 7, 5, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 5), (5, 5), (7, 5)]
    assert simhash.near_duplicates(make_docs([])).collect() == []


def test_components_of_chain_star_and_ring(spark, rng):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    ring = [(i, i + 1) for i in range(900, 920)] + [(920, 900)]
    edges = chain + star + ring + [(3, 3), (None, 4)] + chain[:5]
    rng.shuffle(edges)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == brute_components({x for e in real for x in e}, real)


def test_runs():
    start, length = runs(np.array([2, 2, 5, 7, 7, 7]))
    assert start.tolist() == [0, 2, 3] and length.tolist() == [2, 1, 3]
    assert [len(x) for x in runs(np.array([], np.int64))] == [0, 0]


def test_posting_list_longer_than_a_batch(spark):
    """Thousands of fingerprints that share six bytes, and tasks without rows."""
    simhash.small_batches(spark)
    values = [0x1122334455660000 + 11 * i for i in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.fingerprint_links(frame, 2).collect()
    flips = [1 << i for i in range(16)] + [(1 << i) + (1 << j) for i in range(16) for j in range(i)]
    have = set(values)
    want = {(v, v ^ f) for v in values for f in flips if v < v ^ f and v ^ f in have}
    assert len(found) == len(want) and {(min(r.a, r.b), max(r.a, r.b)) for r in found} == want
    work = simhash._links_of_postings(2)
    assert [b.num_rows for b in work(iter([]))] == [0]
    assert simhash.fingerprint_links(frame.limit(0).repartition(3), 2).collect() == []
