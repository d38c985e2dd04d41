import random

import numpy as np
import pytest

from brightwash.llm import toxicity
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401

BAD = ["vilewort", "grimslur", "nastig"]


def sentence(r, bad):
    words = prose(r, r.randint(10, 60)).split()
    for _ in range(r.randint(1, 4) if bad else 0):
        words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "en", "ly"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def examples():
    r = random.Random(8)
    return [(i, sentence(r, i % 6 == 0), int(i % 6 == 0)) for i in range(600)]


@pytest.fixture(scope="module")
def model(examples):
    return toxicity.NearestExamples(examples, k=7)


def test_terms_go_with_the_label(model):
    assert model.terms and all(any(t.startswith(b[:4]) for b in BAD) for t in model.terms)


def test_nearest_equal_exhaustive_search(model, examples):
    vectors = [dict(model.vector(t)) for _, t, _ in examples]
    r = random.Random(1)
    for text in [sentence(r, True) for _ in range(60)] + ["nothing here", ""]:
        own = dict(model.vector(text))
        cosine = np.round([sum(w * v.get(t, 0.0) for t, w in own.items()) for v in vectors], 9)
        order = [e for e in np.lexsort((np.arange(len(cosine)), -cosine)) if cosine[e] > 0][: model.k]
        found, got = model.nearest(model.vector(text))
        assert np.allclose(got, cosine[order]) and found.tolist() == order


def test_index_skips_blocks(model):
    assert model.blocks > 5 and (model.most >= 0).all()
    for t, row in enumerate(model.most):
        for b, most in enumerate(row):
            a, z = model.start[t * model.blocks + b], model.start[t * model.blocks + b + 1]
            assert most == (model.weight[a:z].max() if z > a else 0)
            assert (model.example[a:z] // toxicity.BLOCK == b).all()


def test_held_out(make_docs, spark, examples, rng):
    texts = [t for _, t, _ in examples] + [sentence(rng, i % 3 == 0) for i in range(90)] + edge_texts(rng)
    docs = make_docs(texts, extra=CLASHING)
    labels = spark.createDataFrame([(i, y, None) for i, _, y in examples] + [(3, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    rows = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows.values())
    for i in range(90):
        assert (rows[600 + i].score >= 0.7) == (i % 3 == 0)
    assert all(r.evidence == "" or r.evidence.count(":") >= 2 for r in rows.values())
    clean = {round(rows[i].score, 9) for i in range(690, len(texts))}
    assert len(clean) == 1 and clean.pop() < 0.1  # null, empty and repeated texts alike


def test_bounded_sample(make_docs, spark, examples):
    docs = make_docs([t for _, t, _ in examples])
    labels = spark.createDataFrame([(i, y) for i, _, y in examples], "doc_id long, toxic int")
    small = toxicity.fit(docs, labels, examples_per_label=30)
    assert 30 <= len(small.ids) <= 100 and 0.3 < small.labels.mean() < 0.7


def test_nothing_learned(make_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs(["a b", None])
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.0, 0.0]
    one = toxicity.fit(docs, spark.createDataFrame([(0, 0)], "doc_id long, toxic int"))
    assert all(r.score < 0.01 for r in toxicity.score(docs, one).collect())
    assert toxicity.score(make_docs([]), one).collect() == []
