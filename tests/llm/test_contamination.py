import random

import pytest

from brightwash.llm import contamination
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def distance(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of item to a substring of text, and its first end."""
    row = list(range(len(item) + 1))
    best = (row[-1], 0)
    for j, c in enumerate(text, 1):
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
        row = new
        best = min(best, (row[-1], j), key=lambda b: b[0])
    return best


def edited(rng, text, share):
    out = list(text)
    for _ in range(int(len(text) * share)):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice("abcdefgh")]
    return "".join(out)


def test_edit_distance_equals_the_table():
    r = random.Random(4)
    for _ in range(300):
        item = bytes(r.choice(b"abc") for _ in range(r.randint(1, 70)))
        text = bytes(r.choice(b"abc") for _ in range(r.randint(0, 60)))
        if r.random() < 0.5:
            text += item[r.randint(0, 5) :]
        want = distance(item, text)
        assert contamination.edit_distance_within(item, text, len(item)) == want
        assert contamination.edit_distance_within(item, text, want[0] - 1) is None


def test_normalised():
    text = "  Ab--c É× 1! ".encode()
    got, place = contamination.normalised(text)
    assert got.tobytes().decode() == "ab c é× 1"
    assert [text[p : p + 1].lower() for p in place[:2]] == [b"a", b"b"]
    assert len(contamination.normalised(b"")[0]) == len(contamination.normalised(b" .,! ")[0]) == 0


@pytest.fixture
def benchmark(spark, rng):
    items = [prose(rng, n) for n in (8, 12, 20, 30, 45, 45, 60, 150)] + ["short one", "?!", "", None]
    return items, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_exact_and_edited_passages(make_docs, benchmark, rng):
    items, table = benchmark
    long = [i for i, t in enumerate(items) if t and len(t) > 60]
    texts, want = edge_texts(rng), {}
    for i in long:
        for change in (str, str.upper, lambda t: t.replace(" ", "\n -- "), lambda t: edited(rng, t, 0.08)):
            want[len(texts)] = i
            texts.append(f"{prose(rng, rng.randint(0, 40))} {change(items[i])} {prose(rng, rng.randint(0, 40))}")
    texts += [prose(rng, 200) for _ in range(60)]
    rows = contamination.find_items(make_docs(texts, extra=CLASHING), table).collect()
    assert len(rows) == len(texts) and set(CLASHING) <= set(rows[0].asDict())
    found = {(r.doc_id, m.item_id): m for r in rows for m in r.matches}
    missed = [(d, i) for d, i in want.items() if (d, i) not in found]
    assert not [x for x in missed if (x[0] - 14) % 4 < 3] and len(missed) <= 1  # exact ones all, edited ones nearly all
    # every match is right: distance, and the bytes told
    for (d, i), m in found.items():
        item = contamination.normalised(items[i].encode())[0].tobytes()
        own = contamination.normalised(texts[d].encode()[m.start : m.end])[0].tobytes()
        assert distance(item, contamination.normalised(texts[d].encode())[0].tobytes())[0] == m.distance == distance(item, own)[0]
        assert m.distance <= 0.2 * len(item)
    assert {d for d, i in found if i in long} <= set(want)


def test_short_items_and_blocks(make_docs, benchmark, rng, monkeypatch):
    items, table = benchmark
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 300)
    texts = [f"{prose(rng, 10)} Short, one! {prose(rng, 9)}", items[0] + " " + items[5], prose(rng, 100)]
    found = [{m.item_id for m in r.matches} for r in contamination.find_items(make_docs(texts), table).sort("doc_id").collect()]
    assert 8 in found[0] and {0, 5} <= found[1] and not found[2] & set(range(8))


def test_recall_at_the_threshold(rng):
    items = [(i, contamination.normalised(prose(rng, rng.randint(20, 60)).encode())[0]) for i in range(60)]
    index = contamination.ItemIndex(items, 0.8, 0.97)
    hits = sum(i in index.matches([index._edited(t)])[0] for i, t in enumerate(index.texts) for _ in range(2))
    assert hits >= 0.85 * 2 * len(items)


def test_empty_tables(make_docs, benchmark):
    _, table = benchmark
    assert contamination.find_items(make_docs([]), table).collect() == []
    assert [r.matches for r in contamination.find_items(make_docs(["a", None]), table.limit(0)).collect()] == [[], []]


def test_recall_is_reached_on_other_edits_or_reported(rng, monkeypatch):
    sizes = [20] * 100 + [60] * 20  # the long items follow the first hundred
    items = [(i, contamination.normalised(prose(rng, n).encode())[0]) for i, n in enumerate(sizes)]
    index = contamination.ItemIndex(items, 0.8, 0.97)
    assert index.recall >= 0.97
    letters = lambda n: prose(rng, n).encode()
    hits = 0
    for i, text in enumerate(index.texts):
        passage = letters(9) + b" " + edited(rng, text.decode(), 0.2).encode() + b" " + letters(9)
        hits += i in index.matches([contamination.normalised(passage)[0]])[0]
    assert hits >= 0.93 * len(items)
    monkeypatch.setattr(contamination, "MOST_REPEATS", 1)
    monkeypatch.setattr(contamination, "MOST_STRIDE", 1 << 20)
    with pytest.warns(UserWarning, match="1 tables find"):
        assert contamination.ItemIndex(items, 0.8, 0.97).recall < 0.97
