import hashlib
from collections import Counter

import numpy as np
import pytest

from brightwash.llm import suffixes
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[s : s + length] for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(int)) == 1))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(frame, texts, length):
    found = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeats(frame, length, filter_bits=16).collect()}
    assert found == dict(enumerate(brute(texts, length)))


def mixed(rng, count=40):
    shared = [prose(rng, 12) for _ in range(4)]
    texts = edge_texts(rng)[:8] + ["ab" * 300, "aaaa" * 100, "a" * 39, "a" * 40]
    for _ in range(count):
        parts = [prose(rng, rng.randint(1, 25))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), prose(rng, rng.randint(0, 9))]
        texts.append(" ".join(parts))
    near = prose(rng, 60).split()
    for i in range(6):
        copy = list(near)
        copy[i * 7] = "other"
        texts.append(" ".join(copy))
    return texts + texts[20:23]


@pytest.mark.parametrize("length", [40, 41])
def test_equals_brute_force(make_docs, rng, length):
    texts = mixed(rng)
    check(make_docs(texts, extra=CLASHING), texts, length)


def test_large_groups_are_cut(make_docs, rng, monkeypatch):
    """With room for two stretches in a group every step of the cutting runs."""
    monkeypatch.setattr(suffixes, "GROUP", 2)
    texts = mixed(rng, 25)
    check(make_docs(texts), texts, 40)


def test_long_text_over_several_chunks(make_docs, rng, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    texts = [prose(rng, 1500), prose(rng, 50)]
    texts += [texts[0][700:4000] + texts[1], texts[0][:2500]]
    check(make_docs(texts), texts, 40)


def test_null_ids_empty_table_and_kept_text(make_docs, rng):
    same = prose(rng, 50)
    rows = suffixes.remove_repeats(make_docs([same, same, "left " + same[:60]], ids=[None, None, 4]), 40, keep_text=True, filter_bits=16).collect()
    assert sorted(bytes(r.kept) for r in rows) == [b"", b"", b"left "[:5]]
    assert suffixes.remove_repeats(make_docs([]), 40, filter_bits=16).collect() == []


def test_levels_are_the_common_prefixes(rng):
    text = np.array([rng.randrange(3) for _ in range(400)] * 2 + [9])
    order, level = suffixes.bounded_boundaries(text, 12)
    for a, b, got in zip(order, order[1:], level[1:]):
        common = 0
        while common < 12 and max(a, b) + common < len(text) and text[a + common] == text[b + common]:
            common += 1
        assert got == (-1 if common == 12 else common)
