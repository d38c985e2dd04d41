"""Phrase collocations by sampling, negative border and expansion passes.

A phrase is a run of at most ``max_words`` words inside a piece of text; it is
frequent if it occurs ``min_count`` times in its language. A phrase can only be
frequent if the two phrases that it holds one word shorter are.

1. A sample of the documents proposes phrases: those that occur there about as
   often as a frequent one should (with a margin).
2. One pass over all documents counts every proposed phrase and the negative
   border: all phrases that are not proposed but whose two shorter phrases are
   (any word, any pair of proposed words and so on).
3. A phrase of the border that turns out frequent is a failure: longer phrases
   around it were not counted. Failures join the proposals, and a further pass
   counts what they made countable and no pass counted before, until no failure
   is left. Each pass ends at least one length, so there are at most
   ``max_words`` of them.
4. The phrases found frequent, by now few, are named and counted by their text.

Until step 4 phrases are told apart by 64-bit hashes, so that the many rare ones
of the border cross the shuffle as two numbers each. Two phrases of one hash
can only make a count too large; step 4 then drops them, so the result is exact.

The proposals reach the tasks as a bit table of their hashes, sized by their
number up to ``MAX_BITS``. A false hit is a proposal like any other: it adds
phrases to count and never changes a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_filter, join_one, slices, small_batches, utf8_values, written

SAMPLE_SHARE = 0.25  # of the documents
MARGIN = 0.8  # of the count that a phrase at min_count is expected to have there
MIN_BITS, MAX_BITS = 20, 29  # of the bit table (64 MB at most)
SLICE = 4 << 20  # bytes of text counted at a time
BUCKETS = 64  # partial rankings of a language

_BREAK = b"\xff"  # no UTF-8 text holds this byte
_PIECE_ENDS = bytes(0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256))
# the lowest bits of a counted key: whether it is proposed, and its words
_FLAGS, MOST_WORDS = 4, 7


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different lower-cased words of all texts, and the row of words as
    places among them; ``_BREAK``, at place 0, stands between pieces."""
    data = _BREAK.join([b"", *texts, b""]).lower().translate(_PIECE_ENDS)  # bytes: A-Z only
    data = np.frombuffer(data.replace(_BREAK, b" \xff "), np.uint8)
    inside = (data != 0x20) & (data != 0x09)
    change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    ends = np.r_[0, np.cumsum(change[1::2] - change[::2])]
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inside].tobytes())]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def _passes(table: Broadcast | None, keys: np.ndarray) -> np.ndarray:
    """Which keys a bit table holds (all, without a table)."""
    if table is None:
        return np.ones(len(keys), bool)
    bits = np.frombuffer(table.value, np.uint8)
    slot = (keys >> np.uint64(_FLAGS)).astype(np.int64) & (8 * len(bits) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


class _Slice:
    """Some texts of one language as a row of words."""

    def __init__(self, texts: list[bytes], lang: str):
        self.names, self.at = _words(texts)
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.keys = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.names), np.uint64, len(self.names))

    def phrases(self, max_words: int, old: Broadcast | None, new: Broadcast | None, first: bool):
        """By length, (size, where, keys, proposed, fresh) of all places where a
        phrase begins that the proposals ``new`` make countable. ``fresh`` are those
        that ``old`` did not (``first``: nothing was counted before)."""
        where = np.flatnonzero(self.at > 0)
        word = self.at[where]
        keys, hit_new = self.keys[word], _passes(new, self.keys)[word]
        hit_old = np.zeros(len(word), bool) if first else _passes(old, self.keys)[word]
        yield 1, where, keys, hit_new, np.full(len(word), first)
        for size in range(2, max_words + 1):
            # a longer phrase begins where one begins and the next place begins one too
            left = np.flatnonzero(np.diff(where) == 1)
            left = left[hit_new[left] & hit_new[left + 1]]
            known = hit_old[left] & hit_old[left + 1]
            keys = _mixed(keys[left] * np.uint64(0x9E3779B97F4A7C15) + keys[left + 1] + np.uint64(size))
            where = where[left]
            hit_new, hit_old = _passes(new, keys), known if first else known & _passes(old, keys)
            yield size, where, keys, hit_new, ~known

    def counted(self, where: np.ndarray, size: int) -> tuple[list[bytes], list[int]]:
        """The different phrases of ``size`` words that begin at ``where``, told apart
        by their words, and how often each does."""
        code = self.at[where]
        for k in range(1, size):
            _, code = np.unique(code, return_inverse=True)
            code = code * len(self.names) + self.at[where + k]
        _, one, n = np.unique(code, return_index=True, return_counts=True)
        names, rows = self.names, np.stack([self.at[where[one] + k] for k in range(size)], axis=1).tolist()
        return [b" ".join([names[i] for i in row]) for row in rows], n.tolist()


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, _Slice]]:
    rows: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1))):
        rows.setdefault(lang, []).append(text)
    for lang, texts in rows.items():
        yield lang, _Slice(texts, lang)


def _count(docs: DataFrame, max_words: int, old: Broadcast | None, new: Broadcast | None, first: bool) -> DataFrame:
    """(key, n): the counts of one pass, by hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            for _, own in _by_lang(batch):
                for size, _, keys, proposed, fresh in own.phrases(max_words, old, new, first):
                    flags = np.uint64(size << 1) | proposed[fresh].astype(np.uint64)
                    keys, n = np.unique(keys[fresh] >> np.uint64(_FLAGS) << np.uint64(_FLAGS) | flags, return_counts=True)
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    return docs.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _named(docs: DataFrame, max_words: int, frequent: Broadcast) -> DataFrame:
    """(lang, phrase, words, n): exact counts of the phrases whose hashes the bit
    table holds, and per language the number of words (of 0 words)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 * SLICE):  # a phrase counts once for the more text
            for lang, own in _by_lang(batch):
                found = [([b""], [int(np.count_nonzero(own.at))])]
                found += [own.counted(where[hit], size) for size, where, _, hit, _ in own.phrases(max_words, None, frequent, True)]
                for phrase, n in found:
                    text = pa.array(phrase, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrase), pa.string()), text, pa.array(n, pa.int64())], ["lang", "phrase", "n"])

    found = docs.mapInArrow(work, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return found.withColumn("words", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))))


def frequent_phrases(
    docs: DataFrame, min_count: int, max_words: int, share: float = SAMPLE_SHARE, margin: float = MARGIN
) -> DataFrame:
    """(lang, phrase, words, n) of every phrase of 1 to ``max_words`` words with
    ``min_count`` or more occurrences in its language, and per language one row
    with 0 words and the number of all word occurrences."""
    if not 1 <= max_words <= MOST_WORDS:
        raise ValueError(f"max_words must be 1 to {MOST_WORDS}")
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    least = max(1, int(min_count * share * margin))
    # phrases of full length need no proposal: nothing longer is built on them
    sampled = _count(docs.sample(share, seed=7), max_words - 1, None, None, True)
    proposals = written(sampled.filter(F.col("n") >= least).select("key"), "proposals")
    frequent, old, new, first = None, None, _table(proposals), True
    while True:
        found = written(_count(docs, max_words, old, new, first).filter(F.col("n") >= min_count).select("key"), "counted")
        frequent = found if frequent is None else frequent.unionByName(found)
        proposed, words = F.col("key").bitwiseAND(F.lit(1)) == 1, F.shiftright("key", 1).bitwiseAND(F.lit(MOST_WORDS))
        failed = found.filter(~proposed & (words < max_words))
        if failed.isEmpty():
            break
        proposals = written(proposals.unionByName(failed), "proposals")
        old, new, first = new, _table(proposals), False
    named = _named(docs, max_words, _table(written(frequent, "frequent_keys")))
    return written(named.filter((F.col("n") >= min_count) | (F.col("words") == 0)), "frequent")


def _table(keys: DataFrame) -> Broadcast:
    bits = (32 * max(1, keys.count()) - 1).bit_length()
    return bit_filter(keys.select(F.shiftright("key", _FLAGS).alias("key")), min(MAX_BITS, max(MIN_BITS, bits)))


def cut_score(a: str, l: str, r: str) -> Column:  # noqa: E741 - the parts' names
    """floor(1,000,000 a a / (l r)) of whole numbers in exact decimals."""
    a, l, r = (F.col(c).cast("decimal(38,0)") for c in (a, l, r))  # noqa: E741
    return F.call_function("div", F.lit(1_000_000).cast("decimal(38,0)") * a * a, l * r)


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    max_words: int = 3,
    top: int = 2000,
    covered_percent: int = 50,
    share: float = SAMPLE_SHARE,
    margin: float = MARGIN,
) -> DataFrame:
    """Each language's ``top`` collocations with their counts and scores.

    ``docs`` needs ``text`` and ``lang``; other columns are not read. A null
    text counts as empty, a null lang as ``und``; each of repeated rows counts;
    an empty table, or one without a frequent phrase, gives no rows. Columns: lang, rank, phrase, a (the
    phrase's count), l and r (those of the two parts at the lowest-scoring
    cut), n (the language's words), score.

    Ties in score go to the larger a, then to the smaller phrase in byte order.
    Scores are exact for counts up to 10**16.
    """
    frequent = frequent_phrases(docs, min_count, max_words, share, margin)
    candidates = frequent.filter("words >= 2")

    # every cut of every candidate with the counts of its two parts
    at = F.split("phrase", " ")
    cut = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(at, 1, k), " ").alias("head"),
            F.array_join(F.slice(at, k + 1, F.col("words")), " ").alias("rest"),
        ),
    )
    cuts = candidates.select("lang", "phrase", "words", F.col("n").alias("a"), F.inline(cut))
    parts = frequent.filter(F.col("words").between(1, max_words - 1))
    cuts = join_one(written(cuts, "cuts"), parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = join_one(written(cuts, "cuts"), parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    scored = cuts.withColumn("score", cut_score("a", "l", "r"))
    scored = scored.groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("low")
    )

    # candidates that a longer one mostly covers
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1), lambda start: F.array_join(F.slice(at, start, size), " ")
            ),
        )
    )
    longer = candidates.filter("words >= 3").select("lang", F.explode(inner).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a"))
    )

    # the best of each bucket first, so that no task ranks a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "low.l", "low.r", "low.score", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)).alias("bucket"))
    part = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))
    rows = rows.withColumn("place", part).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    rows = rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    total = frequent.filter("words = 0").select("lang", F.col("n").alias("total"))
    return rows.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
