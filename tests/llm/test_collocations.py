import re
from collections import Counter, defaultdict

import pytest
from brightwash.llm import collocations as c
from llm_fixtures import CLASHING, edge_texts, make_docs, prose, rng  # noqa: F401

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(texts, langs, min_count=10, top=2000, covered=50):
    f, n = defaultdict(Counter), Counter()
    for text, lang in zip(texts, langs):
        lang = lang or "und"
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        rows = []
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        longer = defaultdict(int)
        for p, a in cand.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        for p, a in cand.items():
            if p in longer and 100 * longer[p] >= covered * a:
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(frame, **kw):
    rows = c.collocations(frame, **kw)
    assert rows.columns == COLUMNS
    return sorted(tuple(r) for r in rows.collect())


@pytest.fixture
def mixed(rng):  # noqa: F811
    words = {lang: [prose(rng, 1, lang) for _ in range(30)] for lang in ("en", "de")}
    texts, langs = list(edge_texts(rng)), []
    langs = [rng.choice(["en", None]) for _ in texts]
    for _ in range(120):
        lang = rng.choice(["en", "en", "de", None, "und"])
        own = words["de" if lang == "de" else "en"]
        picks = [own[min(29, int(rng.expovariate(0.15)))] for _ in range(rng.randint(1, 60))]
        texts.append(rng.choice([" ", "  ", "\t"]).join(w.upper() if rng.random() < 0.1 else w for w in picks))
        if rng.random() < 0.5:
            texts[-1] = texts[-1].replace(" ", rng.choice([". ", ",", "\n", "\x0b", "\xa0"]), 3)
        langs.append(lang)
    return texts + texts[40:44], langs + langs[40:44]


@pytest.mark.parametrize("share", [1.0, 0.25, 0.001])
def test_equals_brute_force(make_docs, mixed, share):  # noqa: F811
    """A tiny sample proposes nearly nothing: then every result comes through
    failures of the border and expansion passes."""
    texts, langs = mixed
    frame = make_docs(texts, langs, extra=[x for x in CLASHING if x != "rank"] + ["rank", "phrase", "words", "a", "n"])
    assert found(frame, share=share) == brute(texts, langs)


def test_top_and_covered_limits(make_docs, mixed):  # noqa: F811
    texts, langs = mixed
    frame = make_docs(texts, langs)
    assert found(frame, top=7, covered_percent=90, min_count=4) == brute(texts, langs, 4, 7, 90)


def test_expansion_passes_run_until_closed(make_docs, monkeypatch):  # noqa: F811
    """Nothing is proposed: words fail first, then pairs, then no failure is left."""
    passes = []
    count = c._count
    monkeypatch.setattr(c, "_count", lambda *a: passes.append(a[-1]) or count(*a))
    rows = found(make_docs(["one two three four"] * 12, ["en"] * 12), share=0.0)
    assert passes == [True, True, False, False]  # the sample, all, and two more
    assert [r[2:4] for r in rows] == [("one two three", 12), ("two three four", 12)]


def test_empty_and_unfrequent_tables(make_docs):  # noqa: F811
    assert found(make_docs([])) == []
    assert found(make_docs([None, "", "only once"])) == []


def test_scores_are_exact_beyond_64_bits(spark):
    numbers = [(10**15, 10**15 + 7, 10**15 + 1), (3 * 10**12 + 1, 9 * 10**14, 3 * 10**12 + 5), (10, 11, 12)]
    frame = spark.createDataFrame(numbers, "a long, l long, r long")
    got = [r[0] for r in frame.select(c.cut_score("a", "l", "r")).collect()]
    assert got == [1_000_000 * a * a // (l * r) for a, l, r in numbers]


def test_hot_words_are_joined_by_broadcast(spark, monkeypatch):
    """Every branch of the split join gives each row once."""
    from brightwash.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 4)
    many = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'the' ELSE 'w' || (id % 40) END AS k")
    one = spark.range(60).selectExpr("'w' || id AS k", "id AS v").union(spark.sql("SELECT 'the', -1L"))
    rows = common.join_one(common.written(many, "many"), one, ["k"])
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, many.join(one, "k").collect()))
