import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from brightwash.llm import langid
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


class Tree:
    """PPM of one language, byte by byte."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            data = bytes(order) + t
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.seen[k, data[i - k : i]][data[i]] += 1

    def bits(self, text):
        data, total = bytes(self.order) + text, 0.0
        for i in range(self.order, len(data)):
            for k in range(self.order, -1, -1):
                context = self.seen.get((k, data[i - k : i]))
                if not context:
                    continue
                n, kinds = sum(context.values()), len(context)
                if data[i] in context:
                    total -= math.log2(context[data[i]] / (n + kinds))
                    break
                total -= math.log2(kinds / (n + kinds))
            else:
                total += 8
        return total


@pytest.fixture(scope="module")
def learned():
    r = random.Random(5)
    return {g: [prose(r, r.randint(5, 60), g) for _ in range(30)] for g in ("de", "en", "fr")}


@pytest.mark.parametrize("order", [0, 1, 3])
def test_code_lengths_equal_the_trees(learned, order):
    langs = sorted(learned)
    lang, gram, n = [], [], []
    for i, g in enumerate(langs):
        own, count = np.unique(langid._grams([bytes(order) + t.encode() for t in learned[g]], order)[0], return_counts=True)
        lang, gram, n = lang + [i] * len(own), gram + own.tolist(), n + count.tolist()
    model = langid.PPM(langs, order, np.array(lang), np.array(gram), np.array(n))
    texts = [t.encode() for g in langs for t in learned[g][:3]] + ["zż ∑ new! 42".encode(), b"t", b""]
    want = [[Tree([x.encode() for x in learned[g]], order).bits(t) for g in langs] for t in texts]
    assert np.allclose(model.code_lengths(texts), want, rtol=1e-4)


def test_long_texts_are_scored_whole(learned, monkeypatch):
    grams, n = np.unique(langid._grams([bytes(2) + t.encode() for t in learned["en"]], 2)[0], return_counts=True)
    model = langid.PPM(["en"], 2, np.zeros(len(grams), np.int64), grams, n)
    text = " ".join(learned["fr"]).encode()
    whole = model.code_lengths([text, b"ab", text])
    monkeypatch.setattr(langid, "CHUNK", 100)
    assert np.allclose(model.code_lengths([text, b"ab", text]), whole, rtol=1e-5)


def test_held_out_accuracy_and_edges(make_docs, learned, rng):
    train = make_docs([t for g in learned for t in learned[g]], [g for g in learned for _ in learned[g]], extra=CLASHING)
    model = langid.train(train)
    fresh = [(prose(rng, 30, g), g) for g in learned for _ in range(30)]
    odd = edge_texts(rng)
    rows = {r.doc_id: r for r in langid.identify(make_docs([t for t, _ in fresh] + odd, extra=CLASHING), model).collect()}
    assert len(rows) == len(fresh) + len(odd)
    assert all(rows[i].lang_pred == g for i, (_, g) in enumerate(fresh))
    for i, t in enumerate(odd, len(fresh)):
        r = rows[i]
        if t is None or not any(c.isalpha() for c in t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in learned and 1 / 3 <= r.score <= 1


def test_sample_bounds_the_training(make_docs, learned):
    frame = make_docs([t for t in learned["en"]] + [t for t in learned["fr"]], ["en"] * 30 + ["fr"] * 30)
    small, whole = langid.train(frame, sample_bytes=500), langid.train(frame)
    assert small.langs == whole.langs == ["en", "fr"]
    assert len(small.cost[3]) < len(whole.cost[3])


def test_no_labels_and_empty(make_docs):
    model = langid.train(make_docs(["a b", None], [None, "en"]))
    assert [(r.lang_pred, r.score) for r in langid.identify(make_docs(["words here", None]), model).collect()] == [("und", 0.0)] * 2
    assert langid.identify(make_docs([]), model).collect() == []


def test_languages_of_one_long_text_are_learned(make_docs):
    """Each has its share of the sample, though it is a single text, and a text
    repeated often neither fills the sample nor is missed."""
    texts, langs = [], []
    for i in range(8):
        r = random.Random(i)
        parts = ["".join(r.choice("abcdefghijklmnop") for _ in range(3)) for _ in range(12)]
        texts.append(" ".join("".join(r.choice(parts) for _ in range(3)) for _ in range(30_000)))
        langs.append(f"l{i}")
    model = langid.train(make_docs(texts + texts[:1] * 20, langs + langs[:1] * 20), sample_bytes=60_000)
    assert model.langs == langs
    rows = langid.identify(make_docs([t[-2000:] for t in texts]), model).collect()
    assert [r.lang_pred for r in sorted(rows, key=lambda r: r.doc_id)] == langs and min(r.score for r in rows) > 0.99
    grams = langid.train(make_docs(texts[:1] * 20, langs[:1] * 20), sample_bytes=60_000)
    assert len(grams.langs) == 1 and len(grams.cost[3]) > 100
