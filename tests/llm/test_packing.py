import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from brightwash.llm import columns, packing
from brightwash.llm.queries import WORD_TOKENIZER
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def optimum(items, room):
    items, best = sorted(items, reverse=True), [len(items)]

    def extend(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        tried = set()
        for j in range(len(bins)):
            if bins[j] + items[i] <= room and bins[j] not in tried:
                tried.add(bins[j])
                bins[j] += items[i]
                extend(i + 1, bins)
                bins[j] -= items[i]
        bins.append(items[i])
        extend(i + 1, bins)
        bins.pop()

    extend(0, [])
    return best[0]


def packed(patterns, room):
    got = Counter()
    for n, items in patterns:
        assert sum(x * k for x, k in items) <= room
        for x, k in items:
            got[x] += n * k
    return got


def test_pack_is_optimal_on_small_cases():
    r = random.Random(1)
    for _ in range(150):
        room = r.choice([10, 20, 50, 100])
        items = [r.randint(1, room) if r.random() < 0.5 else r.randint(room // 5, room // 2) for _ in range(r.randint(0, 11))]
        counts = Counter(items)
        patterns = packing.pack(counts, room)
        assert packed(patterns, room) == counts
        assert packing.lower_bound(counts, room) <= optimum(items, room) == sum(n for n, _ in patterns)


def test_bin_completion_beats_best_fit():
    # best fit decreasing needs a third bin
    counts = Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6])
    assert len(list(packing.best_fit(counts, 61))) >= packing.lower_bound(counts, 61)
    patterns = packing.pack(counts, 61)
    assert packed(patterns, 61) == counts and sum(n for n, _ in patterns) == optimum(list(counts.elements()), 61)


def test_equal_bins_are_handled_together():
    counts = {700: 10**9, 300: 10**9 + 1, 41: 10**6}
    patterns = packing.pack(counts, 1000)
    assert packed(patterns, 1000) == counts and len(patterns) < 50


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_TOKENIZER)


def test_remembered_words_give_the_tokenizers_ids(tokenizer, rng):
    own = packing.WordTokenizer(open(WORD_TOKENIZER, encoding="utf-8").read())
    texts = [prose(rng, 80, lang) for lang in ("en", "de", "fr")] + [t or "" for t in edge_texts(rng)[2:8]]
    texts += ["It's HE'LL don't", "<|endoftext|> x", "İstanbul ǅ ﬁ", "a\x85b\xa0c\x1cd\x00e", "日本 １2³", "é ẞ ΣΑΣ", "O'SÉ's ß\xad+++ 12345"]
    for t in texts * 2:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_pieces_and_places(make_docs, tokenizer, rng):
    texts = edge_texts(rng) + [prose(rng, rng.randint(1, 90)) for _ in range(60)]
    rows = packing.pack_documents(make_docs(texts, extra=CLASHING), WORD_TOKENIZER, capacity=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want = [(n, s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes())) for n, s in enumerate(range(0, len(ids), 64))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == want
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) <= packing.lower_bound(Counter(r.length for r in rows), 64) + 1


def test_null_and_repeated_ids_and_empty_table(make_docs):
    rows = packing.pack_documents(make_docs(["one two"] * 4, ids=[None, None, 3, 3]), WORD_TOKENIZER, capacity=64).collect()
    assert Counter(r.doc_id for r in rows) == {None: 2, 3: 2}
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack_documents(make_docs([]), WORD_TOKENIZER).collect() == []


def test_triples_that_fill_sequences_exactly():
    """Best fit wastes much on these; pattern columns come within one of the
    optimum where bin completion alone does not."""
    for bins, room in ((30, 4096), (60, 1000)):
        r, counts = random.Random(bins), Counter()
        for _ in range(bins):
            a = r.randint(room * 38 // 100, room * 49 // 100)
            b = r.randint(room // 4, (room - a) // 2 + (room - a) // 10)
            counts.update([a, b, room - a - b])
        patterns = packing.pack(counts, room)
        assert packed(patterns, room) == counts
        assert sum(n for n, _ in packing.best_fit(counts, room)) >= bins + 4
        assert bins <= sum(n for n, _ in patterns) <= bins + 1


def test_relaxation_bounds_the_optimum():
    r = random.Random(8)
    for _ in range(40):
        room = r.choice([20, 60])
        counts = Counter(r.randint(room // 6, room // 2) for _ in range(r.randint(3, 12)))
        found, bound = columns.pack_by_columns(counts, room, 99, lambda rest, bins: None)
        best = optimum(list(counts.elements()), room)
        assert packing.lower_bound(counts, room) <= bound <= best <= sum(n for n, _ in found)
        assert packed(found, room) == counts


def test_most_valuable_pattern():
    r = random.Random(9)
    for _ in range(40):
        lengths = np.array(sorted(r.sample(range(2, 12), 3)))
        most, values = np.array([r.randint(1, 3) for _ in lengths]), np.array([r.random() for _ in lengths])
        worth, pattern = columns.best_pattern(lengths, most, values, 17)
        every = [(i, j, k) for i in range(most[0] + 1) for j in range(most[1] + 1) for k in range(most[2] + 1)]
        assert (pattern <= most).all() and pattern @ lengths <= 17 and np.isclose(pattern @ values, worth)
        assert np.isclose(worth, max(np.dot(p, values) for p in every if np.dot(p, lengths) <= 17))
