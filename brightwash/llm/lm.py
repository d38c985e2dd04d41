"""Language-model scores from a log-frequency Bloom filter.

Counts of all words and word pairs of the training rows are gathered by Spark.
Word counts stay exact. The count c of a pair is quantised to the level
1 + floor(log c / log ``LOG_BASE``) and the filter holds the pair once for each
level up to its own; probing level after level until one is missing gives the
level back, never too low and too high only by the filter's error.

A pair's probability is smoothed with Dirichlet's prior towards the word's own
one: P(w|v) = (c(vw) + m p(w)) / (c(v) + m), p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).
The weight m is set so that the mass given to the prior equals the share of
pairs seen once (the Good-Turing estimate of unseen pairs).

log P is a sum of a part that depends on c(w) and c(vw) and a part that depends
on c(v). So the model can be cut by ranges of the word hash: each pass
broadcasts as many ranges as fit ``broadcast_bytes``, scores every text's words
of those ranges, and the sums of the passes are added up. The model grows with
the corpus; a broadcast does not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import runs, slices, small_batches, utf8_values, written

LOG_BASE = 1.5
BITS_PER_ENTRY = 10  # of the filter, for each pair and level
PROBES = 6
SEGMENT_BYTES = 2 << 20  # training text per segment of the model
RANGE_BYTES = 64 << 20  # training text per range of the word hash
ALPHA = 0.1
_END = b"\n"  # no word holds white space
_SEED = 11
_MARK = b"\xff"
_IN_WORD = np.array([b not in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256)])
SLICE = 2 << 20  # bytes of text worked on at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words of all texts, the place there of
    each token, where an end token (place 0) follows each text's words, and the
    number of tokens of each text."""
    # 0xFF, which no UTF-8 text holds, stands for the end token; the first one only takes place 0
    data = _MARK.join([b"", *texts, b""]).lower()  # bytes: A-Z only
    if data.count(_MARK) > len(texts) + 1:  # some text is no UTF-8
        data = _MARK.join([b"", *[t.replace(_MARK, b"\xfe\xfe") for t in texts], b""]).lower()
    data = np.frombuffer(data.replace(_MARK, b" \xff "), np.uint8)
    inside = _IN_WORD[data]
    change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    ends = np.r_[0, np.cumsum(change[1::2] - change[::2])]
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes())]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers).dictionary_encode()
    names = [_END, *coded.dictionary.to_pylist()[1:]]
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, _SEED) for w in names), np.uint64, len(names))
    of = coded.indices.to_numpy().astype(np.int64)
    return hashes, of[1:], np.diff(np.flatnonzero(of == 0))


def contexts(of: np.ndarray) -> np.ndarray:
    """The token before each token; before a text stands the end token."""
    return np.r_[0, of[:-1]]


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of word pairs: the upper 16 bits are the last word's, so that a
    pair lies in the range of its last word; 48 bits tell the pairs apart."""
    return (word & np.uint64(0xFFFF << 48)) | (_mixed(before * np.uint64(0x9E3779B97F4A7C15) + word) >> np.uint64(16))


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(LOG_BASE) + 1e-9).astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """Mean of the whole numbers that have the level (0 for level 0)."""
    low = np.ceil(LOG_BASE ** (level - 1.0) - 1e-6)
    high = np.maximum(low, np.ceil(LOG_BASE ** (level + 0.0) - 1e-6) - 1)
    return np.where(level > 0, (low + high) / 2, 0.0)


def _hashed(pair: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 32-bit hashes of (pair, level) that the probes are made of."""
    key = _mixed(pair + np.uint64(0x632BE59BD9B4E019 * level & 0xFFFFFFFFFFFFFFFF))
    return key & np.uint64(0xFFFFFFFF), (key >> np.uint64(32)) | np.uint64(1)


def _slot(first: np.ndarray, step: np.ndarray, probe: int, size: np.ndarray | int) -> np.ndarray:
    """Bit of a probe in a filter of ``size`` bits."""
    hashed = (first + np.uint64(probe) * step) & np.uint64(0xFFFFFFFF)
    return (hashed * np.asarray(size, np.uint64) >> np.uint64(32)).astype(np.int64)


def build_filter(pairs: np.ndarray, counts: np.ndarray) -> tuple[bytes, int]:
    """Filter of the quantised counts, and its number of bits."""
    level = levels(counts)
    size = max(64, -(-int(level.sum()) * BITS_PER_ENTRY // 8) * 8)
    flags = np.zeros(size, np.uint8)
    for step in range(1, int(level.max(initial=0)) + 1):
        first, move = _hashed(pairs[level >= step], step)
        for probe in range(PROBES):
            flags[_slot(first, move, probe, size)] = 1
    return np.packbits(flags, bitorder="little").tobytes(), size


def probe_levels(bits: np.ndarray, offset: np.ndarray, size: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The level of each pair by repeated probes; ``offset`` (bytes) and
    ``size`` (bits) tell each pair's segment of the filter."""
    out = np.zeros(len(pair), np.int64)
    left, step = np.arange(len(pair)), 0
    while len(left):
        step += 1
        first, move = _hashed(pair[left], step)
        bits_at, bits_in = offset[left], size[left]
        kept = np.arange(len(left))
        for probe in range(PROBES):
            slot = _slot(first, move, probe, bits_in)
            held = np.flatnonzero((bits[bits_at + (slot >> 3)] >> (slot & 7).astype(np.uint8)) & 1)
            if len(held) < len(slot):
                kept, first, move, bits_at, bits_in = kept[held], first[held], move[held], bits_at[held], bits_in[held]
        left = left[kept]
        out[left] = step
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(ranges) >> np.uint64(16)).astype(np.int64)


def _cell(keys: np.ndarray, ranges: int, subs: int) -> np.ndarray:
    """Segment of a word or pair: the range of the (last) word, then spread by
    the lower bits, so that a frequent last word does not load one segment."""
    sub = (keys & np.uint64(0xFFFFFFFF)) * np.uint64(subs) >> np.uint64(32)
    return _range(keys, ranges) * subs + sub.astype(np.int64)


def count_segments(texts: DataFrame, ranges: int, subs: int) -> DataFrame:
    """The model, one row per segment: its words with their counts, its part
    of the filter, and counts for the smoothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            word, of, _ = tokens(utf8_values(part.column(0)))
            pair = np.sort(pair_keys(word[contexts(of)], word[of]))
            first, times = runs(pair)
            out = []
            for kind, distinct, n in ((0, word, np.bincount(of, minlength=len(word))), (1, pair[first], times)):
                cell = _cell(distinct, ranges, subs)
                order = np.argsort(cell.astype(np.uint16) if ranges * subs <= 1 << 16 else cell, kind="stable")
                cell, distinct, n = cell[order], distinct[order], n[order].astype(np.uint32)
                edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    out.append((int(cell[a]), kind, distinct[a:b].tobytes(), n[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["segment", "kind", "keys", "n"])

    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def segment_row(segment: int, held: list[tuple[int, bytes, bytes]]) -> tuple:
        sums = []
        for kind in (0, 1):
            keys = np.frombuffer(b"".join(k for x, k, _ in held if x == kind), np.uint64)
            n = np.frombuffer(b"".join(c for x, _, c in held if x == kind), np.uint32).astype(np.int64)
            sums.append(_summed(keys, n))
        (words, n), (pairs, m) = sums
        bits, size = build_filter(pairs, m)
        return (segment // subs, segment, words.tobytes(), n.tobytes(), len(words), int(n.sum()), bits, size, int((m == 1).sum()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def row() -> pa.RecordBatch:
            columns = zip(segment_row(at, held), row_types)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in columns], row_names)

        for batch in batches:
            for segment, *blob in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != at and held:
                    yield row()
                    held = []
                at = segment
                held.append(blob)
        if held:
            yield row()

    row_types = [pa.int64()] * 2 + [pa.binary()] * 2 + [pa.int64()] * 2 + [pa.binary()] + [pa.int64()] * 2
    row_names = ["range", "segment", "words", "counts", "n_words", "n_tokens", "bits", "size", "once"]
    schema = "range long, segment long, words binary, counts binary, n_words long, n_tokens long, bits binary, size long, once long"
    blobs = texts.select("text").mapInArrow(count, "segment long, kind int, keys binary, n binary")
    return blobs.repartition("segment").sortWithinPartitions("segment").mapInArrow(gather, schema)


def _prior_weight(model: DataFrame, tokens_seen: int, once: int) -> float:
    """The m whose mass on the prior, sum c(v) m/(c(v)+m), is that of the pairs
    seen once."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
            step = np.round(16 * np.log2(np.maximum(n, 1))).astype(np.int64)
            distinct, of = np.unique(step, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct), pa.array(np.bincount(of)), pa.array(np.bincount(of, n).astype(np.int64))], ["step", "words", "total"]
            )

    # at most 16 steps for each doubling of a count
    rows = model.select("counts").mapInArrow(sizes, "step long, words long, total long")
    rows = rows.groupBy("step").agg(F.sum("words").alias("words"), F.sum("total").alias("total")).collect()
    words = np.array([r["words"] for r in rows], float)
    count = np.array([r["total"] for r in rows], float) / np.maximum(words, 1)
    want = min(max(once / max(1, tokens_seen), 1e-6), 1 - 1e-6)
    low, high = 1e-3, 1e9
    for _ in range(100):
        middle = math.sqrt(low * high)
        mass = float((words * count * middle / (count + middle)).sum()) / max(1, tokens_seen)
        low, high = (middle, high) if mass < want else (low, middle)
    return low


def _pass(rows: DataFrame, model: DataFrame, first: int, last: int, ranges: int, subs: int, totals: dict) -> tuple[DataFrame, Broadcast]:
    """Score the words of the ranges first..last (bounded by the caller); also
    the broadcast part of the model."""
    table = model.filter(F.col("range").between(first, last)).drop("range").toArrow()
    words = np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int64)
    order = np.argsort(words)
    counts = counts[order]
    if not len(counts) or counts.max() < 1 << 32:
        counts = counts.astype(np.uint32)
    cells = (last - first + 1) * subs
    offset, size = np.zeros(cells, np.int64), np.full(cells, 64, np.int64)
    at, blobs = 8, [bytes(8)]  # a segment without pairs has no bit set
    for segment, bits, n in zip(*(table.column(c).to_pylist() for c in ("segment", "bits", "size"))):
        offset[segment - first * subs], size[segment - first * subs] = at, n
        blobs.append(bits)
        at += len(bits)
    sent = rows.sparkSession.sparkContext.broadcast((words[order].tobytes(), counts, b"".join(blobs), offset, size))
    del table, words, blobs

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, bits, offset, size = sent.value
        words, bits = np.frombuffer(words, np.uint64), np.frombuffer(bits, np.uint8)
        norm = totals["N"] + ALPHA * (totals["V"] + 1)

        def lookup(distinct: np.ndarray) -> np.ndarray:
            if not len(words):
                return np.zeros(len(distinct))
            near = np.minimum(np.searchsorted(words, distinct), len(words) - 1)
            return np.where(words[near] == distinct, counts[near], 0).astype(np.float64)

        for part in slices(batches, "text", SLICE):
            word, of, sizes = tokens(utf8_values(part.column(2)))
            before = contexts(of)
            own = _range(word, ranges)
            own = (own >= first) & (own <= last)
            count = np.where(own, lookup(word), 0.0)
            prior = (count + ALPHA) / norm
            base = np.where(own, np.log10(prior), 0.0)
            # tokens of these ranges: their pairs are in the filter
            mine = np.flatnonzero(own[of])
            # frequent pairs have the most levels: each different pair is probed once
            pair, again = np.unique(pair_keys(word[before[mine]], word[of[mine]]), return_inverse=True)
            cell = _cell(pair, ranges, subs) - first * subs
            level = probe_levels(bits, offset[cell], size[cell], pair)[again]
            hit = np.flatnonzero(level)
            gain = np.zeros(len(of))
            gain[mine[hit]] = np.log10(1 + level_count(level[hit]) / (totals["m"] * prior[of[mine[hit]]]))
            # contexts of these ranges: c(v); the end token stands before a text
            weight = np.where(own, np.log10(totals["m"] / (count + totals["m"])), 0.0)
            start = np.cumsum(sizes) - sizes
            total = lambda x: np.add.reduceat(x, start)
            columns = [sizes, total((count > 0)[of].astype(np.int64)), total(base[of]), total(base[of] + gain + weight[before])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, columns)], names)

    names = ["id", "h", "n_tokens", "n_known", "base_score", "score"]
    return rows.mapInArrow(score, "id long, h long, n_tokens long, n_known long, base_score double, score double"), sent


def score_texts(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = 96 << 20,
) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score,
    score. ``training`` (a condition on the rows) chooses what is learned.

    Null and empty texts are the end token alone. Repeated rows are counted and
    returned as often as they occur; ids may be null. Without training rows
    every word is unknown. Further columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )
    learned = rows.filter("training")
    size = learned.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    subs = max(1, -(-size // (SEGMENT_BYTES * ranges)))
    model = written(count_segments(learned, ranges, subs), "model")
    per_range = model.groupBy("range").agg(
        *[F.sum(c).alias(c) for c in ("n_words", "n_tokens", "once")], F.sum(F.col("size") / 8 + F.col("n_words") * 16).alias("bytes")
    )
    found = sorted(per_range.collect(), key=lambda r: r["range"])  # a row for 64 MB of text
    totals = {"N": sum(r["n_tokens"] for r in found), "V": sum(r["n_words"] for r in found)}
    totals["m"] = _prior_weight(model, totals["N"], sum(r["once"] for r in found)) if found else 1.0

    bounds, used = [0], 0
    for r in found:
        if used and used + r["bytes"] > broadcast_bytes:
            bounds.append(r["range"])
            used = 0
        used += r["bytes"]
    bounds.append(ranges)
    texts = rows.select("id", F.xxhash64("text").alias("h"), "text")
    parts = []
    for first, after in zip(bounds, bounds[1:]):
        scored, sent = _pass(texts, model, first, after - 1, ranges, subs, totals)
        if len(bounds) > 2:  # one part of the model is out at a time
            scored = written(scored, "pass")
            sent.destroy()
        parts.append(scored)
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.union(p)
        out = out.groupBy("id", "h").agg(
            F.max("n_tokens").alias("n_tokens"),
            (F.count("*") / len(parts)).cast("int").alias("times"),
            *[F.sum(c).alias(c) for c in ("n_known", "base_score", "score")],
        )
        times = F.col("times")
        out = out.select(
            "id",
            "n_tokens",
            (F.col("n_known") / times).cast("long").alias("n_known"),
            (F.col("base_score") / times).alias("base_score"),
            (F.col("score") / times).alias("score"),
            F.explode(F.sequence(F.lit(1), times)),
        )
    return out.select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(totals["N"]).cast("long").alias("train_tokens"), "base_score", "score"
    )
