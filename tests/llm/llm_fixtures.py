import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside; a table may hold them too
CLASHING = ["id", "h", "k", "fp", "score", "matches", "spans", "kept", "label", "rank", "length", "part", "component_id", "n_tokens"]

SYLLABLES = {
    "en": "the ing tion er and ea th ou re st in on".split(),
    "de": "sch ein ung der ich heit keit ver auf ge be ß".split(),
    "fr": "eau que les ou é ment tre ai eux oi è ç".split(),
}


def prose(rng: random.Random, words: int, lang: str = "en") -> str:
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, langs=None, ids=None, extra=()):
        rows = []
        for i, t in enumerate(texts):
            doc = ids[i] if ids is not None else i
            rows.append((doc, t, langs[i] if langs else None, None, None if t is None else len(t), *["x"] * len(extra)))
        return spark.createDataFrame(rows, DOCS + "".join(f", {c} string" for c in extra))

    return make


@pytest.fixture
def rng():
    return random.Random(11)


def edge_texts(rng: random.Random) -> list[str | None]:
    """Null, empty, blank, one character, no letter, very long, repeated rows."""
    long = prose(rng, 40_000)
    same = prose(rng, 150)
    return [None, None, "", "", "  \n\t ", "x", "+++ 42 ***", "日本語テキスト", long, long, same, same, same, prose(rng, 120)]
