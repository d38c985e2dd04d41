import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightwash.llm import fingerprints as fp
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def weights(text, shingle):
    words = text.lower().split()
    if len(words) < shingle:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1))


def jaccard(a, b, shingle):
    a, b = weights(a, shingle), weights(b, shingle)
    both = sum((a | b).values())
    return sum((a & b).values()) / both if both else 1.0


@pytest.mark.parametrize("shingle", [1, 2, 3])
def test_collision_rate_is_the_generalised_jaccard_similarity(rng, shingle):  # noqa: F811
    """Words that occur from once to often, so that the weights matter."""
    vocab = [prose(rng, 1) for _ in range(12)]
    texts = [" ".join(vocab[min(11, int(rng.expovariate(0.4)))] for _ in range(rng.randint(1, 90))) for _ in range(24)]
    tags = fp.sign([t.encode() for t in texts], samples=2048, shingle=shingle)
    for i in range(len(texts)):
        for j in range(i):
            exact = jaccard(texts[i], texts[j], shingle)
            assert abs((tags[i] == tags[j]).mean() - exact) < 0.055  # five standard errors at most


def test_terms_and_weights(rng):  # noqa: F811
    texts = ["a b a b a b", "", "  \n", "one", "One", "x y", "y x", prose(rng, 300)]
    for shingle in (1, 2, 3):
        text, _, weight = fp.weighted_terms([t.encode() for t in texts], shingle)
        for i, t in enumerate(texts):
            assert sorted(weight[text == i]) == sorted(weights(t, shingle).values())


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, edit, next_ = fp.sign([t.encode() for t in (text, edited, after)])
        tag = lambda x: x.astype(">u2").tobytes().hex()
        near = [float((own == x).mean()) for x in (edit, next_)]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), tag(own), tag(edit), *near))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in fp.next_likeness(frame).collect()), key=str)


@pytest.mark.parametrize("part_bytes", [1 << 30, 3000])
def test_next_documents_and_edits(make_docs, rng, monkeypatch, part_bytes):  # noqa: F811
    """One range, and many: the neighbour may lie in the next one, and the
    last document's is the first."""
    monkeypatch.setattr(fp, "PART_BYTES", part_bytes)
    monkeypatch.setattr(fp, "SLICE", 5000)
    texts = edge_texts(rng) + ["größe über straße " * 9, "\U0001f600 " * 50] + [prose(rng, rng.randint(0, 80)) for _ in range(60)]
    ids = rng.sample(range(-10_000, 10**12), len(texts) - 6) + [None, None, None, 77, 77, 77]
    frame = make_docs(texts, ids=ids, extra=CLASHING).repartition(5)
    assert found(frame) == brute(list(zip(ids, texts)))


def test_ranges_are_spread(make_docs, rng, monkeypatch):  # noqa: F811
    monkeypatch.setattr(fp, "PART_BYTES", 2000)
    rows, parts = fp._in_order(make_docs([prose(rng, 60) for _ in range(80)]))
    sizes = [r[1] for r in rows.groupBy("part").count().collect()]
    assert parts == len(sizes) > 5 and max(sizes) < 3 * 80 / parts


def test_few_documents(make_docs):  # noqa: F811
    assert found(make_docs([])) == []
    assert found(make_docs(["alone here"], ids=[5])) == brute([(5, "alone here")])
    assert found(make_docs([None, "b c d"], ids=[None, None])) == brute([(None, None), (None, "b c d")])


def test_equal_texts_and_likeness(make_docs, rng):  # noqa: F811
    texts = edge_texts(rng) + [prose(rng, 200)]
    frame = make_docs(texts, extra=["fingerprint", "tags"])
    rows = fp.fingerprints(frame).select("text", "fingerprint").collect()
    assert all((a.fingerprint == b.fingerprint) == (" ".join((a.text or "").lower().split()) == " ".join((b.text or "").lower().split())) for a in rows for b in rows)
    spark = frame.sparkSession
    pairs = [(a.fingerprint, b.fingerprint) for a in rows for b in rows[-3:]]
    got = spark.createDataFrame(pairs, "a string, b string").select(fp.likeness("a", F.col("b"))).collect()
    tags = [[np.array([x[i : i + 4] for i in range(0, 256, 4)]) for x in p] for p in pairs]
    assert [r[0] for r in got] == [float((a == b).mean()) for a, b in tags]


def test_edited_texts_stay_nearer_than_the_next(make_docs, rng):  # noqa: F811
    rows = fp.next_likeness(make_docs([prose(rng, 200) for _ in range(40)])).collect()
    assert min(r.near_edited for r in rows) > max(r.near_next for r in rows)
