"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Terms are words and word beginnings (inflected and compound forms share them)
whose presence goes with label 1 beyond chance in the labelled examples; the
test is corrected for the number of terms tried. The examples, a bounded
sample of the labelled rows, are held in an inverted index whose postings are
cut into blocks of examples with the largest weight of each block. A text is
looked up block by block in falling order of the bound that these maxima give,
until no block left can hold one of its ``k`` nearest: the result is that of
an exhaustive comparison. The neighbours vote with their similarity, and a
logistic map fitted on the examples (each scored without itself) turns the
vote into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, slices, small_batches

_WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 6)  # letters of the word beginnings that are terms
BLOCK = 64  # examples in a block of the index
EXACT = 1e-6  # slack for rounding in the bounds


def _forms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def _tail(n: int, hits: int, rate: float) -> float:
    """log of the chance that at least ``hits`` of ``n`` fall to a class that
    holds ``rate`` of all (Chernoff's bound)."""
    if hits <= n * rate:
        return 0.0
    q = hits / n
    out = -n * q * math.log(q / rate)
    return out - n * (1 - q) * math.log((1 - q) / (1 - rate)) if q < 1 else out


class NearestExamples:
    """The fitted index. Ties in similarity go to the earlier example."""

    def __init__(self, examples: list[tuple[int | None, str, int]], weights: tuple[float, float] = (1.0, 1.0), k: int = 15, chance: float = 0.1):
        self.k = k
        self.ids = [e[0] for e in examples]
        self.labels = np.array([e[2] for e in examples], np.int64)
        self.terms = self._choose([e[1] for e in examples], chance)
        self.known: dict[str, list[int]] = {}
        rows = [self._row(e[1]) for e in examples]
        df = np.bincount([t for r in rows for t, _ in r], minlength=len(self.terms))
        self.idf = np.log((1 + len(rows)) / (1 + df)) + 1.0
        vectors = [self._vector(r) for r in rows]
        blocks = -(-len(rows) // BLOCK)
        postings = sorted((t, e, w) for e, v in enumerate(vectors) for t, w in v)
        self.example = np.array([p[1] for p in postings], np.int64)
        self.weight = np.array([p[2] for p in postings])
        term = np.array([p[0] for p in postings], np.int64)
        cell = term * blocks + self.example // BLOCK
        self.start = np.searchsorted(cell, np.arange(len(self.terms) * blocks + 1))
        self.most = np.zeros(len(self.terms) * blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(len(self.terms), blocks)
        self.blocks = blocks
        self.known.clear()
        votes = [self.vote(v, leave_out=e)[0] for e, v in enumerate(vectors)]
        self._calibrate(np.array(votes), np.array(weights)[self.labels] if len(rows) else np.empty(0))

    def _choose(self, texts: list[str], chance: float) -> dict[str, int]:
        """Terms that go with label 1 beyond chance. Near copies count once: a
        term's examples are told apart by two min-hashes of their word pairs."""
        rate = float(self.labels.mean()) if len(self.labels) else 0.0
        if not 0 < rate < 1:
            return {}
        digest = xxhash.xxh64_intdigest
        term, copy = [], [[], []]
        for text in texts:
            words = _WORD.findall(text.lower())
            own = np.array([digest(t) for t in {f for w in set(words) for f in _forms(w)}], np.uint64)
            pairs = np.array([digest(f"{v} {w}") for v, w in zip(words, words[1:])] or [0], np.uint64)
            term.append(own)
            copy[0].append(pairs.min())
            copy[1].append((pairs * np.uint64(0x9E3779B97F4A7C15)).min())
        of = np.repeat(np.arange(len(texts)), [len(t) for t in term])
        distinct, term = np.unique(np.concatenate(term), return_inverse=True)
        limit = math.log(chance / max(1, len(distinct)))
        good = np.ones(len(distinct), bool)
        for hashes in copy:
            _, group = np.unique(np.array(hashes, np.uint64), return_inverse=True)
            kinds = group * 2 + self.labels
            met = np.unique(term * (2 * len(texts)) + kinds[of])
            hits = np.bincount(met // (2 * len(texts)), weights=met % 2, minlength=len(distinct))
            n = np.bincount(met // (2 * len(texts)), minlength=len(distinct))
            for t in np.flatnonzero(good).tolist():
                good[t] = _tail(int(n[t]), int(hits[t]), rate) < limit
        chosen = set(distinct[good].tolist())
        kept = {f for text in texts for w in set(_WORD.findall(text.lower())) for f in _forms(w) if digest(f) in chosen}
        return {t: i for i, t in enumerate(sorted(kept))}

    def _row(self, text: str | None) -> list[tuple[int, int]]:
        """(term, occurrences) of the chosen terms of a text."""
        row: dict[int, int] = {}
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for word, n in Counter(_WORD.findall((text or "").lower())).items():
            at = known.get(word)
            if at is None:
                at = known[word] = [self.terms[f] for f in _forms(word) if f in self.terms]
            for t in at:
                row[t] = row.get(t, 0) + n
        return list(row.items())

    def _vector(self, row: list[tuple[int, int]]) -> list[tuple[int, float]]:
        raw = [(t, (1 + math.log(n)) * self.idf[t]) for t, n in sorted(row)]
        norm = math.sqrt(sum(w * w for _, w in raw))
        return [(t, w / norm) for t, w in raw]

    def vector(self, text: str | None) -> list[tuple[int, float]]:
        """The unit vector of a text over the chosen terms."""
        return self._vector(self._row(text))

    def nearest(self, vector: list[tuple[int, float]], leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the highest cosine above 0, and the cosines."""
        if not vector or not self.blocks:
            return np.empty(0, np.int64), np.empty(0)
        terms, weights = np.array([t for t, _ in vector]), np.array([w for _, w in vector])
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        score = np.zeros(self.blocks * BLOCK)
        at, step, kth = 0, 4, 0.0
        while at < len(order) and bound[order[at]] > 0 and bound[order[at]] + EXACT >= kth:
            todo = order[at : at + step]
            todo = todo[bound[todo] + EXACT >= max(kth, 2 * EXACT)]
            for t, w in vector:
                cells = t * self.blocks + todo
                a, b = self.start[cells], self.start[cells + 1]
                n = b - a
                posting = np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                score[self.example[posting]] += w * self.weight[posting]
            if leave_out >= 0:
                score[leave_out] = 0.0
            if len(score) > self.k:
                kth = np.partition(score, -self.k)[-self.k]
            at, step = at + step, 2 * step
        # rounded, so that equal texts tie whatever the order of their sums
        score = np.round(score, 9)
        found = np.flatnonzero((score >= np.round(kth, 9)) & (score > 0))
        found = found[np.lexsort((found, -score[found]))][: self.k]
        return found, score[found]

    def vote(self, vector: list[tuple[int, float]], leave_out: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Votes for label 1 of the neighbours, each weighted by its squared
        cosine, against all votes and one more against: far neighbours alone
        decide nothing. 0 without neighbours."""
        found, cosine = self.nearest(vector, leave_out)
        weight = cosine**2
        return float((weight * self.labels[found]).sum() / (weight.sum() + 1.0)), found, cosine

    def _calibrate(self, votes: np.ndarray, weights: np.ndarray) -> None:
        """Logistic map from vote to probability, fitted with Platt's targets."""
        self.slope, self.offset = 0.0, -10.0
        hits = float(weights[self.labels == 1].sum())
        rest = float(weights[self.labels == 0].sum())
        if not hits:
            return
        target = np.where(self.labels == 1, (hits + 1) / (hits + 2), 1 / (rest + 2))
        x, at = np.stack([votes, np.ones(len(votes))], axis=1), np.array([1.0, math.log(hits / max(rest, 1.0))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            slope = x.T @ (weights * (p - target)) + 1e-3 * at
            curve = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
            step = np.linalg.solve(curve, slope)
            at -= step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        self.slope, self.offset = float(at[0]), float(at[1])

    def score(self, text: str | None) -> tuple[float, str]:
        """Probability of label 1, and the evidence ``id:label:cosine`` of the
        nearest examples."""
        if not len(self.labels):
            return 0.0, ""
        vote, found, cosine = self.vote(self.vector(text))
        odds = min(30.0, max(-30.0, self.slope * vote + self.offset))
        evidence = ",".join(f"{self.ids[e]}:{self.labels[e]}:{c:.3f}" for e, c in zip(found[:3], cosine[:3]))
        return 1 / (1 + math.exp(-odds)), evidence


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    examples_per_label: int = 2048,
    k: int = 15,
) -> NearestExamples:
    """Fit on about ``examples_per_label`` rows of each label, drawn by the hash
    of their id: this documented bound holds for the index and its broadcast.
    Rows with a null label, id or text teach nothing; equal texts are one
    example with their most frequent label."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)")
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = [min(1.0, examples_per_label / max(1, n.get(x, 0))) for x in (0, 1)]
    limit = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])) * (1 << 30)
    drawn = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < limit)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # the drawn rows are bounded by the parameter, so they may be broadcast
    found = texts.filter("text is not null").join(F.broadcast(drawn), "id").groupBy("text").agg(
        F.min("id").alias("id"), F.round(F.avg("label")).cast("int").alias("label")
    )
    rows = sorted((r["id"], r["text"], r["label"]) for r in found.collect())
    return NearestExamples(rows, (1 / share[0], 1 / share[1]), k)


def score(docs: DataFrame, model: NearestExamples, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence) for every row; only the text is read for the score.

    Null, empty and wordless texts, like all texts without a chosen term, have
    no neighbour and get the rate of such examples. Without labelled examples
    the score is 0. Repeated rows score alike; further columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = Shared(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.get()
        for part in slices(batches, "text"):
            scores, evidence = zip(*[model.score(t) for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.string())], ["id", "score", "evidence"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, score double, evidence string").withColumnRenamed("id", id_col)
