"""Personal data in texts: fixed patterns, and a character tagger on top.

The patterns give the base spans. A bidirectional LSTM with CRF transitions is
trained on windows around them, also with spans put side by side, and finds
further ones that the patterns lose because they read greedily from the left
and do not try again (a phone number that runs into an address, two card
numbers in a row) or in near forms (a phone number without a plus sign).

Every kind holds a digit or an at sign, so only the surroundings of those are
read by the tagger: regions are cut into overlapping windows, each window is
decoded to tag probabilities, and the windows' probabilities are blended, each
weighing more towards its middle, and reconciled by one best path over the
whole region.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, slices, small_batches, written
from .tagger import PAD, CharTagger, encode

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
CONTEXT = 32  # characters around a digit or at sign that belong to its region
LEAST_STEPS = 500  # of training
CONFIDENCE = 0.8  # mean probability that an added span needs

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")
_ANY = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ip_ok(text: str) -> bool:
    # a long part is over 255 whatever its value; leading zeros are allowed
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in text.split("."))


def _card_ok(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern. Found from the at signs, because trying
    every start takes quadratic time on a long run of letters."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, without the failing ones."""
    if not _ANY.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for kind, pattern, ok in ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if ok(m.group())]
    return out


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at signs, merged where they touch."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _tags(spans: list[Span], start: int, end: int) -> list[int]:
    """Tags of text[start:end]; a later kind does not overwrite an earlier one."""
    tags = [0] * (end - start)
    for kind, a, b in sorted(spans):
        if a >= start and b <= end and not any(tags[a - start : b - start]):
            tags[a - start : b - start] = [1 + 2 * kind] + [2 + 2 * kind] * (b - a - 1)
    return tags


def _arrays(examples: list[tuple[str, list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    symbols = np.full((len(examples), WINDOW), PAD, np.int64)
    tags = np.zeros((len(examples), WINDOW), np.int64)
    for i, (text, own) in enumerate(examples):
        symbols[i, : len(text)] = encode(text)
        tags[i, : len(own)] = own
    return symbols, tags


def side_by_side(examples: list[tuple[str, list[int]]], count: int, seed: int = 2) -> list[tuple[str, list[int]]]:
    """Windows in which the spans of two examples follow each other."""
    random, out = np.random.default_rng(seed), []
    spans = []
    for text, tags in examples:
        begin = [i for i, t in enumerate(tags) if t % 2 == 1]
        for b in begin:
            e = b + 1
            while e < len(tags) and tags[e] == tags[b] + 1:
                e += 1
            spans.append((text[:b], text[b:e], tags[b:e], text[e:]))
    while spans and len(out) < count:
        left, right = (spans[int(random.integers(len(spans)))] for _ in range(2))
        if len(out) % 2:  # half of the pairs are of one kind
            same = [s for s in spans if s[2][0] == left[2][0]]
            right = same[int(random.integers(len(same)))]
        before, after = left[0][-20:], right[3][:20]
        gap = " " if random.random() < 0.8 else ", "
        # words stand between sentence and span, so no earlier span is cut open
        before, after = "".join(c for c in before if not _ANY.match(c)), "".join(c for c in after if not _ANY.match(c))
        text = before + left[1] + gap + right[1] + after
        tags = [0] * len(before) + left[2] + [0] * len(gap) + right[2] + [0] * len(after)
        if len(text) <= WINDOW:
            out.append((text, tags))
        else:
            out.append((text[-WINDOW:], tags[-WINDOW:]) if tags[-WINDOW] % 2 == 1 or tags[-WINDOW] == 0 else left_window(left))
    return out


def left_window(span: tuple[str, str, list[int], str]) -> tuple[str, list[int]]:
    before, own, tags, after = span
    before, after = before[-10:], after[: max(0, WINDOW - 10 - len(own))]
    text = (before + own + after)[:WINDOW]
    return text, ([0] * len(before) + tags + [0] * len(after))[:WINDOW]


def _plausible(kind: int, text: str) -> bool:
    """Whether an added span could be one of its kind."""
    if kind == 0:
        local, at, domain = text.partition("@")
        return bool(local and at and re.fullmatch(r"[\w-]+(\.[\w-]+)+", domain) and not re.search(r"\s", local))
    if kind == 1:
        return bool(_IP.fullmatch(text)) and _ip_ok(text)
    if kind == 2:
        return bool(_CARD.fullmatch(text)) and _card_ok(text)
    if not (_phone_ok(text) and re.fullmatch(r"[+(]?[0-9][\x20().0-9-]+[0-9]", text)) or _IP.fullmatch(text):
        return False
    groups = re.findall(r"[0-9]+", text)
    return text[0] == "+" or len(groups) >= 3 and all(2 <= len(g) <= 4 for g in groups)


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def added_spans(texts: list[str], bases: list[list[Span]], model: CharTagger) -> list[list[Span]]:
    """Spans of the tagger that overlap no base span of their text."""
    out: list[list[Span]] = [[] for _ in texts]
    todo = [(i, a, b) for i, t in enumerate(texts) for a, b in regions(t)]
    for at in range(0, len(todo), 256):  # bounds the arrays, not the texts
        _decode(texts, bases, model, todo[at : at + 256], out)
    return out


def _decode(texts, bases, model: CharTagger, todo: list[tuple[int, int, int]], out: list[list[Span]]) -> None:
    rise = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float64)
    for i, a, b in todo:
        # long regions are read in parts that overlap by a window
        for start in range(a, b, 64 * WINDOW):
            end = min(b, start + 64 * WINDOW + WINDOW)
            places = list(range(start, max(start + 1, end - STRIDE), STRIDE))
            windows = np.full((len(places), WINDOW), PAD, np.int64)
            for row, p in enumerate(places):
                symbols = encode(texts[i][p : min(p + WINDOW, end)])
                windows[row, : len(symbols)] = symbols
            found = model.marginals(windows)
            blend, weight = np.zeros((end - start, found.shape[2])), np.zeros(end - start)
            for row, p in enumerate(places):
                n = min(WINDOW, end - p)
                blend[p - start : p - start + n] += found[row, :n] * rise[:n, None]
                weight[p - start : p - start + n] += rise[:n]
            blend /= weight[:, None]
            tags = model.path(np.log(blend + 1e-9))
            at = 0
            while at < len(tags):
                e = at + 1
                if tags[at] % 2 == 1:
                    while e < len(tags) and tags[e] == tags[at] + 1:
                        e += 1
                    sure = blend[np.arange(at, e), tags[at:e]].mean()
                    kind, (x, y) = (int(tags[at]) - 1) // 2, _trimmed(texts[i], start + at, start + e)
                    taken = (*bases[i], *out[i])
                    if sure >= CONFIDENCE and _plausible(kind, texts[i][x:y]) and not any(x < q and p < y for _, p, q in taken):
                        out[i].append((kind, x, y))
                at = e


def train(docs: DataFrame, text_col: str = "text", windows_per_kind: int = 300, epochs: int = 8) -> CharTagger | None:
    """Train on windows around base spans and around other digits.

    About ``windows_per_kind`` windows of each kind and of none are drawn by
    their hash, which bounds the training set; None if there is no span.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            kinds, windows, tags = [], [], []
            for text in part.column(0).to_pylist():
                spans = base_spans(text or "")
                for a, b in regions(text or ""):
                    for start in range(a, b, WINDOW):
                        end = min(b, start + WINDOW)
                        own = [s for s in spans if start <= s[1] and s[2] <= end]
                        cut = [s for s in spans if s not in own and s[1] < end and s[2] > start]
                        if not cut:
                            kinds.append(own[0][0] if own else -1)
                            windows.append(text[start:end])
                            tags.append(bytes(_tags(own, start, end)))
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(windows, pa.string()), pa.array(tags, pa.binary())], ["kind", "window", "tags"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    found = written(rows.mapInArrow(work, "kind int, window string, tags binary"), "windows")
    counts = {r["kind"]: r["n"] for r in found.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if not any(k >= 0 for k in counts):
        return None
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, windows_per_kind / n)))])
    drawn = found.filter(F.pmod(F.xxhash64("window"), F.lit(1 << 30)) < F.element_at(share, F.col("kind")) * (1 << 30))
    examples = [(r["window"], list(r["tags"])) for r in drawn.distinct().sort("window").collect()]
    if not any(any(t) for _, t in examples):
        return None
    examples += side_by_side(examples, len(examples))
    model = CharTagger(len(KINDS))
    # few windows are gone through more often
    batches = -(-len(examples) // 32)
    model.train(*_arrays(examples), epochs=max(epochs, -(-LEAST_STEPS // batches)), batch=32)
    return model


def find_spans(docs: DataFrame, model: CharTagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with its columns and n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (all spans as kind:start:end), redacted (the text with
    each span replaced by its kind in brackets).

    Offsets are code points. Null texts have no spans and stay null in
    redacted. Repeated rows give equal results. Columns of these names are
    replaced.
    """
    small_batches(docs.sparkSession)
    added = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans", "redacted"]
    kept = [c for c in docs.columns if c not in (*added, "__text")]
    shared = Shared(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.get()
        for part in slices(batches, "__text"):
            given = part.column(len(kept)).to_pylist()
            texts = [t or "" for t in given]
            bases = [base_spans(t) for t in texts]
            more = added_spans(texts, bases, model) if model else [[] for _ in texts]
            every = [sorted({*b, *m}) for b, m in zip(bases, more)]
            columns = [pa.array([sum(s[0] == k for s in b) for b in bases], pa.int64()) for k in range(len(KINDS))]
            digests = [hashlib.sha256(spans_text(b).encode()).hexdigest() for b in bases]
            clean = [t if t is None else redact(t, s) for t, s in zip(given, every)]
            columns += [pa.array(c, pa.string()) for c in (digests, [spans_text(s) for s in every], clean)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*part.schema.names[:-1], *added])

    rows = docs.select(*[docs[c] for c in kept], F.col(text_col).cast("string").alias("__text"))
    schema = docs.select(*[docs[c] for c in kept]).schema
    for name in added:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")
    return rows.mapInArrow(work, schema)


def redact(text: str, spans: list[Span]) -> str:
    """Overlapping spans become one, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
