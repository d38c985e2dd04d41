"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of order 0 to ``order`` learned from
labelled texts. A byte costs -log2 n/(N+T) bits in the longest context that
has seen it; every longer context that has not charges its escape, -log2
T/(N+T) (method C: N bytes seen, T different ones), and below order 0 all 256
bytes cost 8 bits. The statistics are frozen after training, so the code
length of a text is a sum of table entries, read here for all bytes at once.
The language with the shortest code wins; its score is its posterior
probability under equal priors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, slices, small_batches

UNKNOWN = "und"
CHUNK = 1 << 19  # bytes scored at a time
PIECE = 1 << 12  # characters of a text drawn for training together
_LETTER = regex.compile(r"\p{L}")


def _folded(text: str | None) -> bytes:
    return (text or "").lower().encode()


def count_grams(labelled: DataFrame, lang_col: str, text_col: str, order: int) -> DataFrame:
    """(lang, gram, n): occurrences of each ``order`` + 1 bytes, packed into a
    long; a text starts after ``order`` zero bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(bytes(order) + _folded(text))
            for lang, texts in by_lang.items():
                grams, n = np.unique(_grams(texts, order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"]
                )

    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of padded texts, and the number of grams of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    grams = data.copy()
    for k in range(1, order + 1):
        grams[k:] += data[:-k] << (8 * k)
    first = np.cumsum(sizes) - sizes
    keep = np.ones(len(data), bool)
    for k in range(order):
        keep[first + k] = False
    return grams[keep], sizes - order


class PPM:
    """Frozen per-language context trees, as tables over the contexts and grams
    seen in any language. Levels are orders; ``cost[k]`` holds a row of bits
    (one per language) for each gram of order ``k``."""

    def __init__(self, langs: list[str], order: int, lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs, self.order = langs, order
        seen = np.unique(np.concatenate([(gram >> (8 * k)) & 255 for k in range(order + 1)]))
        self.symbol = np.full(256, len(seen), np.int64)  # bytes never seen share one symbol
        self.symbol[seen] = np.arange(len(seen))
        self.size = len(seen) + 1
        self.node, self.gram, self.cost, self.escape = [], [], [], []
        code = np.zeros(len(gram), np.int64)
        for k in range(order, -1, -1):
            code = code * self.size + self.symbol[(gram >> (8 * k)) & 255]
        lower = None
        for k in range(order + 1):
            codes, at = np.unique(code % self.size ** (k + 1), return_inverse=True)
            count = np.zeros((len(codes), len(langs)))
            np.add.at(count, (at, lang), n)
            contexts, of = np.unique(codes // self.size, return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(langs)))
            np.add.at(total, of, count)
            np.add.at(kinds, of, count > 0)
            node = np.full(self.size**k, -1, np.int32)
            node[contexts] = np.arange(len(contexts))
            index = np.full(len(contexts) * self.size, -1, np.int32)
            index[of * self.size + codes % self.size] = np.arange(len(codes))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                hit = -np.log2(count / (total + kinds)[of])
            if lower is None:
                below = np.full(count.shape, 8.0)
            else:
                below = lower(codes % self.size**k)
            self.node.append(node)
            self.gram.append(index)
            self.escape.append(escape.astype(np.float32))
            self.cost.append(np.where(count > 0, hit, escape[of] + below).astype(np.float32))
            lower = lambda c, k=k: self.bits(c, k)

    def bits(self, code: np.ndarray, order: int | None = None) -> np.ndarray:
        """Code lengths (one row per gram, one column per language) of grams
        given as symbol codes of ``order`` + 1 symbols."""
        order = self.order if order is None else order
        if order < 0:
            return np.full((len(code), len(self.langs)), 8.0, np.float32)
        node = self.node[order][code // self.size]
        at = self.gram[order][node.astype(np.int64) * self.size + code % self.size]
        at[node < 0] = -1
        out = self.cost[order][at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            below = self.bits(code[miss] % self.size**order, order - 1) if order else self.bits(code[miss], -1)
            known = node[miss] >= 0
            below[known] += self.escape[order][node[miss][known]]
            out[miss] = below
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        pending: list[tuple[int, bytes]] = []

        def flush() -> None:
            grams, sizes = _grams([p for _, p in pending], self.order)
            code = np.zeros(len(grams), np.int64)
            for k in range(self.order, -1, -1):
                code = code * self.size + self.symbol[(grams >> (8 * k)) & 255]
            bits = self.bits(code)
            filled = np.flatnonzero(sizes)
            if len(filled):
                first = (np.cumsum(sizes) - sizes)[filled]
                np.add.at(out, [pending[i][0] for i in filled], np.add.reduceat(bits, first, axis=0, dtype=np.float64))
            pending.clear()

        used = 0
        for i, text in enumerate(texts):
            padded = bytes(self.order) + text
            for start in range(0, len(text), CHUNK):  # a chunk keeps the context before it
                pending.append((i, padded[start : start + CHUNK + self.order]))
                used += len(pending[-1][1])
                if used >= CHUNK:
                    flush()
                    used = 0
        if pending:
            flush()
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        kept = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        out = [(UNKNOWN, 0.0)] * len(texts)
        if kept:
            bits = self.code_lengths([_folded(texts[i]) for i in kept])
            best = bits.argmin(axis=1)
            odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            for i, b, o in zip(kept, best.tolist(), odds.tolist()):
                out[i] = (self.langs[b], 1.0 / o)
        return out


def train(
    labelled: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    order: int = 3,
    sample_bytes: int = 2 << 20,
) -> PPM:
    """Learn from the rows with a text and a language.

    About ``sample_bytes`` of text per language are used, in distinct pieces of
    ``PIECE`` characters drawn by a hash, which bounds the trees; a language of
    no more is learned from whole. Null texts and languages are passed over;
    without labelled rows the model knows no language.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # a text counts once for its language, however many copies there are
    own = rows.groupBy("lang", "h").agg(F.max(F.octet_length("text")).alias("n"))
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return PPM([], 0, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    share = F.element_at(
        F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(min(1.0, sample_bytes / max(1, sizes[g]))))]), F.col("lang")
    )
    # pieces are drawn by the hash of text and place, so that long texts and
    # repeated ones give their share like all others
    last = F.floor((F.greatest(F.char_length("text"), F.lit(1)) - 1) / PIECE).cast("long")
    taken = F.filter(
        F.sequence(F.lit(0).cast("long"), last), lambda i: F.pmod(F.xxhash64("h", i), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    )
    piece = F.transform(taken, lambda i: F.substring("text", (i * PIECE + 1).cast("int"), F.lit(PIECE)))
    drawn = rows.withColumn("share", share).select("lang", F.explode(piece).alias("text")).distinct()
    found = count_grams(drawn, "lang", "text", order).toArrow()
    number = {g: i for i, g in enumerate(langs)}
    lang = np.array([number[g] for g in found.column("lang").to_pylist()], np.int64)
    return PPM(langs, order, lang, found.column("gram").to_numpy(), found.column("n").to_numpy())


def identify(docs: DataFrame, model: PPM, text_col: str = "text") -> DataFrame:
    """``docs`` with its columns and lang_pred, score.

    The prediction reads the text alone. ``und`` with score 0 where the text
    is null or has no letter, or nothing was learned; languages that tie are
    taken in alphabetical order. Columns named lang_pred or score are replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "__text")]
    shared = Shared(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.get()
        for part in slices(batches, "__text"):
            found = model.predict(part.column(len(kept)).to_pylist())
            lang, score = zip(*found)
            columns = [*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "lang_pred", "score"])

    rows = docs.select(*[docs[c] for c in kept], docs[text_col].cast("string").alias("__text"))
    schema = docs.select(*[docs[c] for c in kept]).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(work, schema)
