import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brightwash.llm import lm
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def words(text):
    return (text or "").encode().lower().split() + [b"\n"]


def learnt(doc):
    return zlib.crc32(str(doc).encode()) % 10 != 0


@pytest.fixture
def texts(rng):
    base = [prose(rng, 30) for _ in range(30)]
    return edge_texts(rng) + base + [" ".join(rng.sample(base, 3)) for _ in range(40)] + ["Unheard wörds ONLY"]


def scored(frame, **given):
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    return lm.score_texts(frame, training, **given).collect()


def test_counts_and_base_score(make_docs, texts):
    rows = {r.doc_id: r for r in scored(make_docs(texts, extra=CLASHING))}
    counts = Counter(w for i, t in enumerate(texts) if learnt(i) for w in words(t))
    total, kinds = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        own = words(t)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), total)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_score_is_near_the_exact_model(make_docs, texts):
    rows = {r.doc_id: r for r in scored(make_docs(texts))}
    single, pair = Counter(), Counter()
    for i, t in enumerate(texts):
        if learnt(i):
            own = words(t)
            single.update(own)
            pair.update(zip([b"\n", *own], own))
    total, kinds = sum(single.values()), len(single)

    def exact(t, m):
        own = words(t)
        p = lambda w: (single[w] + 0.1) / (total + 0.1 * (kinds + 1))
        return sum(math.log10((pair[v, w] + m * p(w)) / (single[v] + m)) for v, w in zip([b"\n", *own], own))

    # the weight follows from the counts: a number between the two that bracket the scores
    errors = {m: sum(abs(rows[i].score - exact(t, m)) for i, t in enumerate(texts)) for m in np.geomspace(0.01, 1e5, 60)}
    assert min(errors.values()) < 0.05 * sum(abs(rows[i].score) for i in rows)


def test_passes_over_ranges_give_the_same(make_docs, texts, monkeypatch):
    frame = make_docs(texts + texts[:3], ids=[*range(len(texts)), None, None, 2])
    one = sorted(tuple(r) for r in ((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in scored(frame)))
    whole = scored(frame)
    monkeypatch.setattr(lm, "RANGE_BYTES", 60_000)
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 9_000)
    cut = scored(frame, broadcast_bytes=20_000)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in cut) == one
    # the filter is another one, so its errors differ a little
    a, b = sum(r.score for r in whole), sum(r.score for r in cut)
    assert abs(a - b) < 0.05 * abs(a)


def test_filter_keeps_quantised_counts():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 2**63, 20_000).astype(np.uint64))
    counts = np.maximum(1, rng.pareto(1.0, len(pairs)) * 2).astype(np.int64)
    bits, size = lm.build_filter(pairs, counts)
    at = np.zeros(len(pairs), np.int64)
    found = lm.probe_levels(np.frombuffer(bits, np.uint8), at, at + size, pairs)
    assert (found >= lm.levels(counts)).all()
    assert (found == lm.levels(counts)).mean() > 0.97
    others = rng.integers(0, 2**63, 20_000).astype(np.uint64) ^ np.uint64(1 << 63)
    zero = lm.probe_levels(np.frombuffer(bits, np.uint8), at[0] + np.zeros(20_000, np.int64), np.full(20_000, size), others)
    assert (zero == 0).mean() > 0.97
    # a level's count is among the counts that have the level
    for c in range(1, 200):
        level = lm.levels(np.array([c]))
        mean = lm.level_count(level)[0]
        assert lm.levels(np.array([math.floor(mean), math.ceil(mean)])).tolist() == [level[0]] * 2


def test_without_training_rows_and_empty(make_docs):
    rows = lm.score_texts(make_docs(["a b", None]), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens) for r in rows] == [(0, 0)] * 2
    assert lm.score_texts(make_docs([]), F.lit(True)).collect() == []


def test_tokens_are_words_and_an_end_for_each_text():
    texts = [b"", b" ", b"A b\x0bC\x0c\x0d\nb", b"\x1c x \xc2\xa0\x00 A", "É ü É".encode(), b"\xff\xff x", b""]
    hashes, of, sizes = lm.tokens(texts)
    told = {}  # hash by word, and the other way round
    place = 0
    for text, size in zip(texts, sizes.tolist()):
        words = [w.replace(b"\xff", b"\xfe\xfe") for w in text.lower().split()] + [None]
        assert size == len(words)
        for word in words:
            assert told.setdefault(word, int(hashes[of[place]])) == hashes[of[place]]
            place += 1
        assert of[place - 1] == 0
    assert place == len(of) and len(set(told.values())) == len(told) == len(hashes)
    assert [x.tolist() for x in lm.tokens([b""])[1:]] == [[0], [1]]


def test_equal_pairs_of_a_slice_are_probed_once(spark, monkeypatch):
    probed = []
    real = lm.probe_levels
    monkeypatch.setattr(lm, "probe_levels", lambda bits, offset, size, pair: probed.append(pair) or real(bits, offset, size, pair))

    class Rows:  # runs the task's function here
        sparkSession = None

        def __init__(self, batch):
            self.batch = batch

        def mapInArrow(self, work, schema):
            return list(work([self.batch]))

    class Model:
        def __init__(self, table):
            self.table = table

        filter = drop = lambda self, *args: self

        def toArrow(self):
            return self.table

    word, of, _ = lm.tokens([b"a b a b a b"] * 3)
    pair, n = np.unique(lm.pair_keys(word[lm.contexts(of)], word[of]), return_counts=True)
    bits, size = lm.build_filter(pair, n)
    counts = np.bincount(of).astype(np.int64)
    table = pa.table({"segment": [0], "words": [word.tobytes()], "counts": [counts.tobytes()], "bits": [bits], "size": [size]})
    rows = Rows(pa.RecordBatch.from_pydict({"id": [1, 2], "h": [1, 2], "text": ["a b a b a b", "b a"]}))
    rows.sparkSession = spark
    out, _ = lm._pass(rows, Model(table), 0, 0, 1, 1, {"N": int(counts.sum()), "V": 3, "m": 1.0})
    assert out[0].column(2).to_pylist() == [7, 3]
    assert len(probed) == 1 and len(np.unique(probed[0])) == len(probed[0])
