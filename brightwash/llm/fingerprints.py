"""Document fingerprints by consistent weighted sampling.

A text is a set of weighted terms: its pairs of adjacent lower-cased words
(``shingle`` words in general; a text of fewer words is one term), each with
its number of occurrences as weight S. For every term and every sample j three
variates are fixed by a hash of the term and j alone: r and c drawn from
Gamma(2, 1) and b from [0, 1). With t = floor(ln S / r + b), the term's value is
c / exp(r (t - b + 1)). The sample j of a text is the (term, t) of the smallest
value. Two texts agree in a sample with a probability equal to the generalised
Jaccard similarity of their weights, sum of minima over sum of maxima, so
the share of equal samples estimates it without bias.

A fingerprint is ``samples`` tags of 16 bits in hexadecimal. Tags are 1 to
65535; a text without words has the tag 0 everywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches, utf8_values

SAMPLES = 64
SHINGLE = 2
SLICE = 1 << 20  # bytes of text signed at a time
CHUNK = 1 << 15  # terms
PART_BYTES = 16 << 20  # text per range of ids
MAX_PARTS = 1 << 20  # their lower ends are broadcast: 8 MB at most

_BLANKS = bytes(0x20 if b in b"\x09\x0a\x0b\x0c\x0d" else b for b in range(256))
_TWICE = np.float32(2 * np.log(2.0**16))


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different lower-cased words of all texts, the place there of
    each word, an end mark (place 0) after each text's words, and the words and
    mark of each text."""
    data = b"".join(t.lower() + b" \xff " for t in (b"", *texts))  # no UTF-8 text holds the mark's byte
    data = np.frombuffer(data.translate(_BLANKS), np.uint8)
    inside = data != 0x20
    change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    ends = np.r_[0, np.cumsum(change[1::2] - change[::2])].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes())])
    coded = words.dictionary_encode()
    of = coded.indices.to_numpy().astype(np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 11) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return hashes, of[1:], np.diff(np.flatnonzero(of == 0))


def weighted_terms(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight) of all distinct terms of all texts, by text."""
    hashes, of, sizes = _coded(texts)
    text = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    left = np.repeat(begin + sizes - 1, sizes) - np.arange(len(of))  # words from here to the text's end
    whole = np.repeat(sizes - 1, sizes)
    first = np.arange(len(of)) == begin[text]
    # a term begins here: a full shingle, or the only one of a short text
    starts = np.flatnonzero((left >= shingle) | (first & (whole > 0) & (whole < shingle)))
    term = np.zeros(len(starts), np.uint64)
    for k in range(shingle):
        there = k < left[starts]
        word = np.where(there, hashes[of[np.minimum(starts + k, len(of) - 1)]], np.uint64(k))
        term = _mixed(term * np.uint64(0x9E3779B97F4A7C15) + word)
    text = text[starts]
    # equal terms of a text meet under one hash, then the texts come in order again
    met = _mixed(term + text.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(met)
    start = np.flatnonzero(np.diff(met[order], prepend=~met[order[:1]]))
    weight, one = np.diff(np.r_[start, len(order)]), order[start]
    by_text = np.argsort(text[one], kind="stable")
    return text[one][by_text], term[one][by_text], weight[by_text]


def _draws(term: np.ndarray, log_weight: np.ndarray, samples: int) -> np.ndarray:
    """For each sample (row) and weighted term, its value as the upper 32 bits
    in ascending order, and below them a mark of (term, t)."""
    out = np.empty((samples, len(term)), np.uint64)
    for at in range(0, len(term), CHUNK):  # what is worked on stays in the cache
        part = slice(at, at + CHUNK)
        own, heavy = term[part] >> np.uint64(32), np.flatnonzero(log_weight[part] > 0)  # a weight of 1 has t = 0
        log_heavy = log_weight[part][heavy]
        for j in range(samples):
            drawn = term[part] * np.uint64(0xD1342543DE82EF95 * (2 * j + 1) & 0xFFFFFFFFFFFFFFFF)
            drawn ^= drawn >> np.uint64(29)
            drawn *= np.uint64(0xBF58476D1CE4E5B9)
            drawn ^= drawn >> np.uint64(32)
            parts = drawn.view(np.uint16).reshape(-1, 4)
            even = parts.astype(np.float32)  # evenly spread over (0, 2**16)
            even += np.float32(0.5)
            # sums of two exponential variates each
            r = _TWICE - np.log(even[:, 0] * even[:, 1])
            c = _TWICE - np.log(even[:, 2] * even[:, 3])
            drawn *= np.uint64(0x9E3779B97F4A7C15)
            b = parts[:, 3] * np.float32(2.0**-16)
            value = np.log(c)
            value -= r * (np.float32(1) - b)
            row = out[j, part]
            if len(heavy):
                t = np.floor(log_heavy / r[heavy] + b[heavy])
                value[heavy] -= r[heavy] * t
            # floats in their order as integers: of negative ones all bits but the sign change
            bits = value.view(np.int32)
            bits ^= (bits >> np.int32(31)) & np.int32(0x7FFFFFFF)
            np.add(bits, np.int64(1 << 31), out=row.view(np.int64), dtype=np.int64)
            row <<= np.uint64(32)
            row |= own
            if len(heavy):
                later = heavy[t > 0]
                mark = _mixed(own[later] + (t[t > 0].astype(np.uint64) << np.uint64(32))) >> np.uint64(32)
                row[later] += mark - own[later]
    return out


def sign(texts: list[bytes], samples: int = SAMPLES, shingle: int = SHINGLE) -> np.ndarray:
    """The tags (uint16) of each text, ``samples`` a text."""
    tags = np.zeros((len(texts), samples), np.uint16)
    text, term, weight = weighted_terms(texts, shingle)
    if not len(term):
        return tags
    _, one, place = np.unique(_mixed(term ^ _mixed(weight.astype(np.uint64))), return_index=True, return_inverse=True)
    signed, starts = np.unique(text, return_index=True)
    draws = _draws(term[one], np.log(weight[one]).astype(np.float32), samples)
    for j in range(samples):
        least = np.minimum.reduceat(draws[j].take(place, mode="clip"), starts) & np.uint64(0xFFFFFFFF)
        tags[signed, j] = 1 + _mixed(least) % np.uint64(0xFFFF)
    return tags


def _hex(tags: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in tags.astype(">u2")]


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", samples: int = SAMPLES, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of the column ``text`` as column ``out``.

    Map-only. A null text counts as empty; equal texts get equal fingerprints;
    all other columns stay, except that one named ``out`` is replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(out)
    schema = docs.withColumn(out, F.lit("")).schema
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE):
            tags = sign(utf8_values(batch.column(at)), samples, shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_hex(tags))], names=[*batch.schema.names, out])

    return docs.mapInArrow(work, schema)


def likeness(a: Column | str, b: Column | str, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprint columns (0 to 1; null if one
    is null): the estimate of the generalised Jaccard similarity."""

    def tags(print_: Column | str) -> Column:
        whole = F.col(print_) if isinstance(print_, str) else print_
        return F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.substring(whole, i * 4 + 1, F.lit(4)))

    same = F.zip_with(tags(a), tags(b), lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.lit(float(samples))


def _in_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """(part, guard, doc_id, text): ``docs`` cut into ranges of descending ids,
    each partition sorted. The first rows of a range are also sent, as
    guards, to the end of the range before; those of the first to the last."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(MAX_PARTS, -(-size // PART_BYTES)))
    ends = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        found = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 10 * parts)).alias("ends"), F.max("doc_id").alias("top"))
        row = found.first()
        if row.top is not None:
            ends = sorted({e for e in row.ends if e < row.top} | {row.top}, reverse=True)
    # the first id of each range, ids descending; range i holds ids from firsts[i] down to above firsts[i + 1]
    firsts = docs.sparkSession.sparkContext.broadcast(np.array(ends[::-1], np.int64).tobytes())
    parts = max(1, len(ends))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ascending = np.frombuffer(firsts.value, np.int64)
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            value = ids.fill_null(0).to_numpy()
            part = np.full(len(value), parts - 1, np.int32)  # null ids come last
            if parts > 1:
                above = np.searchsorted(ascending, value[known], "left")  # range ends below the id
                part[known] = np.minimum(parts - 1 - above, parts - 1) if len(above) else part[known]
            for guard in (False, True):
                rows, place = np.arange(len(value)), part
                if guard:
                    if parts == 1:
                        continue
                    rows = np.flatnonzero(known & np.isin(value, ascending))
                    place = (part[rows] - 1) % parts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place.astype(np.int32)), pa.array(np.full(len(rows), guard)), *batch.take(pa.array(rows)).columns],
                    names=["part", "guard", "doc_id", "text"],
                )

    rows = docs.mapInArrow(work, "part int, guard boolean, doc_id long, text string")
    rows = rows.repartitionById(parts, F.col("part"))
    return rows.sortWithinPartitions("part", "guard", F.desc_nulls_last("doc_id"), "text"), parts


def next_likeness(docs: DataFrame, samples: int = SAMPLES, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next text.

    The next document is the one with the next smaller ``doc_id`` (after the
    last: the first). In the edited form the last third of a text's code points
    (rounded down) is replaced by the first as many, or all, of the next text.
    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next: the likeness of the
    document's fingerprint to the other two.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null
    text counts as empty; documents without an id follow all others; of equal
    ids the smaller text comes first; a single document is its own next one;
    an empty table gives no rows. Texts are shuffled once into ranges of ids
    and each task reads its sorted range as a stream, two texts at a time.
    """
    small_batches(docs.sparkSession)
    rows, parts = _in_order(docs)

    def signed(pairs: list[tuple]) -> pa.RecordBatch:
        """``pairs``: (doc_id, text, next text)."""
        texts, edits, following = [], [], []
        for _, text, after in pairs:
            cut = len(text) // 3
            texts.append(text)
            edits.append(text[: len(text) - cut] + after[:cut])
            following.append(after)
        data = [t.encode() for t in (*texts, *edits, following[-1])]
        tags = sign(data, samples, shingle)
        n = len(pairs)
        # the next text is the next pair's own one, but for the last pair and at a jump
        after = np.r_[tags[1:n], tags[-1:]]
        jumps = [i for i in range(n - 1) if following[i] is not texts[i + 1]]
        if jumps:
            after[jumps] = sign([following[i].encode() for i in jumps], samples, shingle)
        own, edited = tags[:n], tags[n : 2 * n]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pairs], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(d).hexdigest() for d in data[n : 2 * n]]),
                pa.array(_hex(own)),
                pa.array(_hex(edited)),
                pa.array((own == edited).mean(axis=1)),
                pa.array((own == after).mean(axis=1)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, used = [], 0
        opening = waiting = None  # (part, doc_id, text): the range's first row, and the row that has no next one yet
        for batch in batches:
            for part, guard, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if waiting is not None:
                    pairs.append((waiting[1], waiting[2], text))
                    used += len(waiting[2])
                    waiting = None
                    if used >= SLICE or len(pairs) >= 4096:
                        yield signed(pairs)
                        pairs, used = [], 0
                if not guard:
                    waiting = (part, doc, text)
                    opening = opening or waiting
        if waiting is not None:  # the only range of the table closes on its own first row
            pairs.append((waiting[1], waiting[2], opening[2]))
        if pairs:
            yield signed(pairs)

    return rows.mapInArrow(
        work,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
