"""Removal of long repeated byte strings by suffix-array interval expansion.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else in the table. The comparison runs in four steps, all of them
Spark jobs over hashes or over pieces of bounded size:

1. Anchors. Every start of ``length`` bytes names an anchor, the leftmost
   smallest hash among the ``CORE``-byte strings inside (winnowing), so equal
   strings name equal anchors at equal places. The starts that name one anchor
   are consecutive; the bytes they cover are the anchor's stretch.
2. Classes. Stretches of equal bytes are counted, not compared. Anchors met
   once hold nothing repeated.
3. Intervals. The different stretches around one anchor are set side by side,
   the bytes they share by construction written as one symbol. A block of such
   groups is put through the Burrows-Wheeler transform, and common prefixes are
   derived by increasing value: breadth-first backward extension of suffix
   intervals, which stops at the length of a whole string. Suffixes that no
   boundary has parted by then share ``length`` bytes.
4. Groups of more than ``GROUP`` different stretches (a passage that very many
   documents share) are cut by the place of the anchor in the string: half the
   starts each, whose strings share more bytes, so that they fall into more
   groups and into classes again, until groups are small enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, in_filter, slices, small_batches, utf8_values, written

GROUP = 512  # most stretches of one anchor compared in one block
BLOCK = 1 << 18  # symbols of a block
CHUNK = 1 << 20  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15 | 1
_POSITION = np.uint64(24)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each bit over the word."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


class Anchors:
    """Anchors of the strings of ``length`` bytes in a buffer."""

    def __init__(self, length: int, core: int):
        self.length, self.core = length, core
        n = CHUNK + length + 1
        self.up = _powers(n, _BASE)
        self.down = _powers(n, pow(_BASE, -1, 1 << 64))

    def find(self, data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For a buffer of at most CHUNK + length bytes and the starts that are
        valid in it: anchor hashes, anchor places, first and last start."""
        k, n = self.core, len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(data.astype(np.uint64) * self.up[:n], out=total[1:])
        hashes = _mixed((total[k:] - total[:-k]) * self.down[: n - k + 1])
        least = (hashes >> _POSITION << _POSITION) | np.arange(len(hashes), dtype=np.uint64)
        have, want = 1, self.length - k + 1
        while have < want:
            step = min(have, want - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        place = (least[valid] & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        at = place[first]
        return hashes[at], at, valid[first], valid[last]


def anchor_rows(texts: DataFrame, length: int, core: int) -> DataFrame:
    """(core, cls, k, h, place, lo, hi) for texts (k, h, text): the anchor's hash,
    its stretch's hash, the text's key, the anchor's place in the text, and how
    far before it the last and the first of its strings start."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, core)
        for part in slices(batches, "text", CHUNK):
            keys = [part.column(i).to_numpy() for i in (0, 1)]
            out: list[list[np.ndarray]] = []
            held: list[tuple[int, int, bytes]] = []  # text number, offset in the text, bytes

            def flush() -> None:
                whole = b"".join(b for _, _, b in held)
                sizes = np.array([len(b) for _, _, b in held])
                begin = np.cumsum(sizes) - sizes
                n = sizes - length + 1
                valid = np.repeat(begin - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                hashes, at, s, e = finder.find(np.frombuffer(whole, np.uint8), valid)
                digest = xxhash.xxh3_64_intdigest
                lo, hi = at - e, at - s
                seeds = (hi * 1024 + lo).tolist()
                cls = np.array(
                    [digest(whole[a : b + length], seed) for a, b, seed in zip(s.tolist(), e.tolist(), seeds)], np.uint64
                )
                of = np.searchsorted(begin, s, "right") - 1
                row = np.array([r for r, _, _ in held])[of]
                offset = np.array([o for _, o, _ in held])[of]
                out.append([hashes.view(np.int64), cls.view(np.int64), keys[0][row], keys[1][row], at - begin[of] + offset, lo, hi])
                held.clear()

            used = 0
            for i, text in enumerate(utf8_values(part.column(2))):
                for start in range(0, max(0, len(text) - length + 1), CHUNK):
                    piece = text[start : start + CHUNK + length - 1]
                    if used + len(piece) > CHUNK + length and held:
                        flush()
                        used = 0
                    held.append((i, start, piece))
                    used += len(piece)
            if held:
                flush()
            for columns in out:
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    names = ["core", "cls", "k", "h", "place", "lo", "hi"]
    return texts.select("k", "h", "text").mapInArrow(work, ", ".join(f"{c} long" for c in names))


# ------------------------------------------------------------- the transform


def _suffix_order(seq: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes by their first ``symbols`` symbols or more."""
    _, rank = np.unique(seq, return_inverse=True)
    have = 1
    while True:
        following = np.zeros(len(seq), np.int64)
        following[:-have] = rank[have:] + 1
        key = rank * (rank.max() + 2) + following
        order = np.argsort(key, kind="stable")
        step = np.r_[False, key[order[1:]] != key[order[:-1]]]
        rank[order] = np.cumsum(step)
        have *= 2
        if have >= min(symbols, len(seq)) or step[1:].all():
            return order


def bounded_boundaries(seq: np.ndarray, symbols: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """(order, level): the suffix order, and for each place in it the length of
    the common prefix with the place before, -1 if it is ``symbols`` or more."""
    order = _suffix_order(seq, symbols + 1)
    n = len(seq)
    bwt = seq[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    after, before = np.full(n, n), np.full(n, -1)
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    level = np.full(n + 1, -1, np.int64)
    level[0] = level[n] = 0
    lb, rb = np.array([0]), np.array([n - 1])
    for length in range(symbols):
        sizes = rb - lb + 1
        of = np.repeat(np.arange(len(lb)), sizes)
        at = np.arange(len(of)) + np.repeat(lb - (np.cumsum(sizes) - sizes), sizes)
        last, first = after[at] > rb[of], before[at] < lb[of]
        # the interval of each symbol put before this one: from the mapped first
        # to the mapped last occurrence; sorted, the two lists correspond
        end, start = lf[at[last]], lf[at[first]]
        end, start = end[np.lexsort((end, of[last]))], start[np.lexsort((start, of[first]))]
        new = level[end + 1] < 0
        lb, rb = start[new], end[new]
        level[rb + 1] = length
        if not len(lb):
            break
    return order, level[:n]


def repeated_runs(rows: list[tuple[int, int, int, int, bytes, bytes]]) -> list[tuple[int, int, int]]:
    """For stretches (group, n, lo, hi, left, right) of one block, all with cells
    lo..hi of the same width: (row, from, to) for each run of starts, told by
    their distance before the anchor, whose string occurs more than once."""
    parts, begin, at = [], [], 0
    for group, _, _, _, left, right in rows:
        seq = np.empty(len(left) + len(right) + 2, np.int64)
        seq[: len(left)] = np.frombuffer(left, np.uint8) + 1
        seq[len(left)] = 257 + group
        seq[len(left) + 1 : -1] = np.frombuffer(right, np.uint8) + 1
        seq[-1] = 0
        parts.append(seq)
        begin.append(at)
        at += len(seq)
    order, level = bounded_boundaries(np.concatenate(parts), rows[0][3] - rows[0][2] + 1)
    prefix = np.empty(at, np.int64)
    prefix[order] = np.cumsum(level >= 0)
    row, start, distance = [], [], []
    for i, (_, _, lo, hi, left, right) in enumerate(rows):
        near, far = hi - len(right), lo + len(left)
        row.append(np.full(far - near + 1, i))
        start.append(begin[i] + np.arange(far - near + 1))
        distance.append(far - np.arange(far - near + 1))
    row, start, distance = map(np.concatenate, (row, start, distance))
    weight = np.bincount(prefix[start], weights=np.array([r[1] for r in rows])[row])
    hit = weight[prefix[start]] > 1
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    out = []
    for a, b in zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()):
        cuts = np.flatnonzero(row[a + 1 : b + 1] != row[a:b]) + a + 1
        for x, y in zip([a, *cuts.tolist()], [*(cuts - 1).tolist(), b]):
            out.append((int(row[x]), int(distance[y]), int(distance[x])))
    return out


_STRETCH = "g1 long, g2 long, cls long, n long, lo int, hi int, left binary, right binary"
_NAMES = ["g1", "g2", "cls", "n", "lo", "hi", "left", "right"]


def _compare(groups: DataFrame) -> DataFrame:
    """(g1, g2, cls, near, far): repeated runs of starts within small groups."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        number: dict[tuple, int] = {}
        block = [(number.setdefault(r[:2], len(number)), *r[3:]) for r in rows]
        found = [(*rows[i][:3], a, b) for i, a, b in repeated_runs(block)]
        columns = list(zip(*found)) if found else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["g1", "g2", "cls", "near", "far"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        used = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (row[5] - row[4] != held[-1][5] - held[-1][4] or used > BLOCK and row[:2] != held[-1][:2]):
                    yield solve(held)
                    held, used = [], 0
                held.append(row)
                used += len(row[6]) + len(row[7]) + 2
        if held:
            yield solve(held)

    width = F.col("hi") - F.col("lo")
    sorted_groups = groups.select(*_NAMES).repartition("g1", "g2").sortWithinPartitions(width, "g1", "g2")
    return sorted_groups.mapInArrow(work, "g1 long, g2 long, cls long, near long, far long")


def _halve(groups: DataFrame) -> DataFrame:
    """The stretches of a cell cut into its two halves: the child's columns,
    and the parent's key as p1, p2, pcls."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g1, g2, cls, n, lo, hi, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                near, far = hi - len(right), lo + len(left)
                middle = (lo + hi) // 2
                for a, b in ((lo, middle), (middle + 1, hi)):
                    x, y = max(a, near), min(b, far)
                    if x > y:
                        continue
                    inner = (left[len(left) - (a - lo) :], right[: hi - b])
                    own = (left[far - y : len(left) - (a - lo)], right[hi - b : hi - x])
                    group = xxhash.xxh3_128_digest(b"%d %d %d %d " % (g1, g2, a, len(inner[0])) + b"".join(inner))
                    child = xxhash.xxh3_64_intdigest(b"%d %d " % (x, y) + b"".join(own)) - (1 << 63)
                    halves = np.frombuffer(group, np.int64).tolist()
                    out.append((*halves, child, n, a, b, *own, g1, g2, cls))
            columns = list(zip(*out)) if out else [[]] * 11
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*_NAMES, "p1", "p2", "pcls"])

    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()] * 2 + [pa.int64()] * 3
    return groups.select(*_NAMES).mapInArrow(work, _STRETCH + ", p1 long, p2 long, pcls long")


def repeated_in_groups(stretches: DataFrame) -> DataFrame:
    """(g1, g2, cls, near, far) for a written table of different stretches."""
    sizes = stretches.groupBy("g1", "g2").agg(F.count("*").alias("size"))
    sized = written(stretches.join(sizes, ["g1", "g2"]), "groups")
    found = written(_compare(sized.filter(F.col("size") <= GROUP)), "runs")
    if sized.filter(F.col("size") > GROUP).isEmpty():
        return found
    members = written(_halve(sized.filter(F.col("size") > GROUP)), "halves")
    children = members.groupBy("g1", "g2", "cls").agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("lo", "hi", "left", "right")]
    )
    below = repeated_in_groups(written(children.select(*_NAMES), "children"))
    parents = members.select("g1", "g2", "cls", "p1", "p2", "pcls").join(below, ["g1", "g2", "cls"])
    return found.union(parents.select("p1", "p2", "pcls", "near", "far"))


# --------------------------------------------------------------- the operator


def _cut_out(length: int):
    """Bytes around the anchors listed with each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            out = []
            for text, wanted in zip(utf8_values(part.column(0)), part.column(1).to_pylist()):
                for w in wanted:
                    at, left = w["place"], text[w["place"] - w["hi"] : w["place"]]
                    right = text[at + w["core_bytes"] : at - w["lo"] + length]
                    out.append((w["core"], 0, w["cls"], w["n"], 0, length - w["core_bytes"], left, right))
            columns = list(zip(*out)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _NAMES)

    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()] * 2
    return work


def _merged(runs: list[dict], n: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 26, keep_text: bool = False
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are read as UTF-8 bytes; null counts as empty, and texts shorter than
    ``length`` lose nothing. Rows with equal text lose all of it if it is long
    enough, whether or not their ids are equal or null. With ``keep_text`` the
    remaining bytes follow as binary column ``kept``. ``filter_bits`` sizes the
    two bit tables that spare texts and anchors a shuffle (2 to that power
    bits, broadcast); it does not change the result. Further columns are not
    read, and an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    core = length // 2
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.xxhash64("id").alias("k"), F.xxhash64("text").alias("h"), "text"
    )
    anchors = written(anchor_rows(rows.filter(F.octet_length("text") >= length), length, core), "anchors")
    often = bit_filter(anchors.select("core"), filter_bits, at_least=2)
    some = written(in_filter(anchors, often, "core"), "often")
    classes = some.groupBy("core", "cls").agg(
        F.count("*").alias("n"), F.min(F.struct("k", "h", "place", "lo", "hi")).alias("of")
    )
    classes = written(classes.select("core", "cls", "n", "of.*"), "classes")
    several = classes.groupBy("core").agg(F.count("*").alias("size")).filter("size > 1")
    unclear = written(classes.join(several, "core").drop("size"), "unclear")

    # the bytes of one stretch of each class whose anchor has several classes
    wanted = unclear.groupBy("k", "h").agg(
        F.collect_list(F.struct("core", "cls", "n", "place", "lo", "hi", F.lit(core).alias("core_bytes"))).alias("wanted")
    )
    wanted = written(wanted, "wanted")
    keys = F.xxhash64("k", "h")
    holders = in_filter(rows.withColumn("key", keys), bit_filter(wanted.select(keys), filter_bits), "key")
    holders = holders.select("k", "h", "text").join(wanted, ["k", "h"]).select("text", "wanted")
    stretches = holders.mapInArrow(_cut_out(length), _STRETCH).dropDuplicates(["g1", "g2", "cls"])
    runs = repeated_in_groups(written(stretches, "stretches"))

    # repeated runs of starts, as bytes of the texts
    copies = some.join(classes.filter("n > 1").select("core", "cls"), ["core", "cls"], "left_semi")
    alone = classes.filter("n = 1").join(
        runs.select(F.col("g1").alias("core"), "cls", "near", "far"), ["core", "cls"]
    )
    covered = copies.select("k", "h", (F.col("place") - F.col("hi")).alias("a"), (F.col("place") - F.col("lo") + length).alias("b"))
    covered = covered.union(
        alone.select("k", "h", (F.col("place") - F.col("far")).alias("a"), (F.col("place") - F.col("near") + length).alias("b"))
    )
    removed = written(covered.groupBy("k", "h").agg(F.collect_set(F.struct("a", "b")).alias("runs")), "removed")
    touched = bit_filter(removed.select(keys), filter_bits)

    # only texts that may lose something are shuffled; the others are finished here
    bits = touched

    def finish_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, mask = np.frombuffer(bits.value, np.uint8), (1 << filter_bits) - 1
        for part in slices(batches, "text"):
            slot = part.column(4).to_numpy() & mask
            hit = (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            texts = utf8_values(part.column(3))
            kept = [t if x or keep_text else None for t, x in zip(texts, hit.tolist())]
            digest = [hashlib.sha256(t).hexdigest() for t in texts]
            columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], ["id", "k", "h", "n_bytes", "sha", "bytes"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes"):
            out = []
            for doc, n, sha, text, found in zip(*(c.to_pylist() for c in part.columns)):
                spans = _merged(found, n) if found else []
                if spans:
                    edges = [0, *(x for s in spans for x in s), n]
                    text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    sha = hashlib.sha256(text).hexdigest()
                out.append((doc, n, sum(b - a for a, b in spans), len(spans), sha, *[text] * keep_text))
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text]
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text
    schema = "id long, k long, h long, n_bytes long, sha string, bytes binary"
    known = rows.withColumn("key", keys).mapInArrow(finish_clean, schema).join(removed, ["k", "h"], "left")
    out_schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return known.select("id", "n_bytes", "sha", "bytes", "runs").mapInArrow(finish, out_schema + ", kept binary" * keep_text)
