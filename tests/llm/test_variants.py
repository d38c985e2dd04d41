import re
import zlib
from collections import Counter

from brightwash.llm import variants as v
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(count):
    near = {w: [x for x in count if one_edit(w, x)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, count[w], len(near[w]), form[w], count.get(form[w]), root))
    return sorted(out)


def grouped(spark, count):
    frame = spark.createDataFrame(list(count.items()), "word string, n long")
    rows = v.variant_groups(frame)
    assert rows.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, rows.collect()))


def test_groups_equal_brute_force(spark, rng):  # noqa: F811
    """Few letters and lengths around the blocks: many neighbours of each kind,
    repeated letters, ties and chains."""
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 14))) for _ in range(500)}
    words |= {"a" * k for k in range(5, 30)} | {"abcd" * k for k in (2, 3, 4)} | {"abcd" * k + "a" for k in (2, 3, 4)}
    base = [prose(rng, 1) * 2 for _ in range(30)]
    for w in base:
        for _ in range(4):
            i = rng.randrange(len(w))
            words |= {w[:i] + w[i + 1 :], w[:i] + "z" + w[i + 1 :], w[:i] + "z" + w[i:]}
    words = {w for w in words if len(w) >= 5}
    count = {w: rng.choice([3, 3, 3, 4, 6, 7, 12, 13, 25, 60, 200]) for w in sorted(words)}
    assert grouped(spark, count) == brute(count)


def test_very_long_words(spark, rng):  # noqa: F811
    long = "".join(rng.choice("abcdefgh") for _ in range(9_000))
    count = {long: 9, long[:4000] + long[4001:]: 3, long[:8_500] + "x" + long[8_501:]: 4, "ñ" + long: 20, long[::-1]: 3, long[:5]: 3}
    rows = {w: (near, form, root) for w, _, near, form, _, root in grouped(spark, count)}
    assert rows[long] == (3, "ñ" + long, "ñ" + long)
    assert rows[long[:4000] + long[4001:]] == (1, long, "ñ" + long)
    assert rows[long[::-1]] == (0, None, long[::-1]) and rows[long[:5]] == (0, None, long[:5])


def test_long_chain_and_equal_counts(spark):
    chain = {"aaaaa" + "b" * k: 3 * 2**k for k in range(12)}
    assert grouped(spark, chain) == brute(chain)
    ties = {"house": 3, "mouse": 6, "louse": 6, "rouse": 5}
    assert grouped(spark, ties) == brute(ties)
    assert {w: f for w, _, _, f, _, _ in grouped(spark, ties)}["house"] == "louse"


def test_common_prefix_held_by_all_words(spark, rng):  # noqa: F811
    count = {"pre" + "".join(rng.choice("abcdefghij") for _ in range(3)) + "ation": rng.randint(3, 40) for _ in range(300)}
    assert grouped(spark, count) == brute(count)


def counted(texts, ids):
    out = Counter()
    for doc, text in zip(ids, texts):
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def test_words_of_documents(make_docs, rng):  # noqa: F811
    vocab = [prose(rng, 1, lang) for lang in ("en", "de", "fr") for _ in range(60)] + ["ÀÉaÿ×÷ß", "Ünïcode"]
    texts = [t for t in edge_texts(rng) if t is None or len(t) < 5000]
    texts += [" ".join(rng.choice(vocab).title() for _ in range(80)) + rng.choice([".", "1x2", "_", "\n"]) for _ in range(70)]
    ids = [None, *rng.sample(range(10**9), len(texts) - 1)]
    frame = make_docs(texts + texts[-3:], ids=ids + ids[-3:], extra=[*CLASHING, "word", "run", "n"])
    count = counted(texts + texts[-3:], ids + ids[-3:])
    rows = v.spelling_variants(frame).collect()
    assert {r.word: r.n for r in rows} == count
    assert sorted(map(tuple, rows)) == brute(count)


def test_empty_tables(spark, make_docs):  # noqa: F811
    assert v.spelling_variants(make_docs([])).collect() == []
    assert v.spelling_variants(make_docs([None, "", "42 +++", "ab ab ab ab"])).collect() == []
