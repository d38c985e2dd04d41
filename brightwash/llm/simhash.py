"""SimHash near-duplicates through a byte-position inverted index.

Method. Each text gets a 64-bit fingerprint, i.e. eight positional bytes. Two
fingerprints within ``max_bits`` <= 2 differing bits differ in at most two
bytes, so they share at least six positional bytes: that is the guaranteed
minimum of the count filter. The inverted index posts a fingerprint under
every choice of six positional bytes (28 postings), so a pair meets in a
posting exactly when its tally of shared bytes reaches the minimum; pairs with
a lower tally are never formed. A posting list is bounded by construction
(six bytes fixed, 65,536 values of the other two) and is joined by looking up
the up to 136 values within two bits, not by pairing its members; the tally of
shared bytes then decides which posting owns the pair, and the bit distance is
verified. Work and output are linear in the number of distinct fingerprints
whatever the size of a group of copies: copies share one fingerprint and are
represented by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, slices, small_batches, utf8_values, written
from .components import components

SEED = 42
BLOCK = 1 << 15  # shingles counted at a time
BYTES = 8
MINIMUM_SHARED = 6


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 of all word shingles of one UTF-8 text."""
    words = text.lower().split()  # bytes.lower and bytes.split: A-Z, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        part = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in part], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long. Null and empty
    texts, and texts without a word, get 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in utf8_values(part.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, fp long")


def _postings() -> list[tuple[int, int]]:
    """(posting kind, mask of the six bytes it fixes) for each left-out pair of bytes."""
    out = []
    for kind, (p, q) in enumerate(combinations(range(BYTES), 2)):
        mask = 0xFFFFFFFFFFFFFFFF & ~(0xFF << 8 * p) & ~(0xFF << 8 * q)
        out.append((kind, mask - (1 << 64) if mask >> 63 else mask))
    return out


def _links_of_postings(max_bits: int):
    """Arrow function over rows (kind, key, fp) sorted by (kind, key, fp)."""
    left_out = np.array(list(combinations(range(BYTES), 2)), np.uint64)
    flips = np.array([m for m in range(1, 1 << 16) if bin(m).count("1") <= max_bits], np.int64)

    def link(kind: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(fp) or not len(flips):  # a batch may lie wholly in the list that is held
            return fp[:0], fp[:0]
        changed = np.r_[True, (kind[1:] != kind[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(changed) - 1
        keep = np.bincount(group)[group] > 1
        kind, fp, group = kind[keep], fp[keep], group[keep]
        if not len(fp):
            return fp[:0], fp[:0]
        shift = left_out[kind] * np.uint64(8)
        rest = ((fp >> shift[:, 0]) & np.uint64(255)) | (((fp >> shift[:, 1]) & np.uint64(255)) << np.uint64(8))
        code = (group.astype(np.int64) << 16) | rest.astype(np.int64)
        order = np.argsort(code)
        code, fp, kind = code[order], fp[order], kind[order]
        a, b = [], []
        for flip in flips:
            want = code ^ flip
            at = np.searchsorted(code, want)
            at[at == len(code)] = 0
            hit = np.flatnonzero((code[at] == want) & (want > code))
            x, y = fp[hit], fp[at[hit]]
            # tally of shared positional bytes
            same = (x ^ y)[:, None].view(np.uint8).reshape(-1, BYTES) == 0
            tally = same.sum(axis=1)
            # a pair with seven shared bytes is in seven postings; one owns it
            other = np.where(left_out[kind[hit], 0] == same.argmin(axis=1), left_out[kind[hit], 1], left_out[kind[hit], 0])
            owner = (tally == MINIMUM_SHARED) | (other == np.where(same.argmin(axis=1) == 0, 1, 0))
            near = np.bitwise_count(x ^ y) <= max_bits
            keep = (tally >= MINIMUM_SHARED) & owner & near
            a.append(x[keep])
            b.append(y[keep])
        return np.concatenate(a), np.concatenate(b)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]

        def out(columns) -> pa.RecordBatch:
            a, b = link(*columns)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new = [new[0].astype(np.int64), new[1], new[2].view(np.uint64)]
            held = [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = len(last) - int(last.sum())  # the last list may go on in the next batch
            yield out([x[:cut] for x in held])
            held = [x[cut:] for x in held]
        yield out(held)

    return work


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): all pairs of the distinct values ``fp`` within ``max_bits`` bits."""
    if not 0 <= max_bits <= BYTES - MINIMUM_SHARED:
        raise ValueError(f"max_bits must be 0 to {BYTES - MINIMUM_SHARED}: more can share fewer than {MINIMUM_SHARED} bytes")
    posting = F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in _postings()])
    )
    return (
        distinct.select("fp", posting.alias("p"))
        .select("p.kind", "p.key", "fp")
        .repartition("kind", "key")
        .sortWithinPartitions("kind", "key")
        .mapInArrow(_links_of_postings(max_bits), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id): one row per input row.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, the row's own included. Null, empty and
    wordless texts have fingerprint zero and are linked like any other. A null
    id is never the smallest; a component of null ids only has a null
    component_id. Repeated rows are linked to each other. An empty table gives
    an empty result; further columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    comp = components(fingerprint_links(nodes.select("fp"), max_bits), "a", "b")
    labelled = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label")
    )
    labelled = written(labelled, "labelled")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "label").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
