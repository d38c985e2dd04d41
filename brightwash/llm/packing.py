"""Best-fit packing of tokenised documents by bin completion.

The packing problem depends on the pieces only through the number of pieces of
each length, and there are at most ``capacity`` lengths. So Spark tokenises
and counts, the driver solves the packing of that histogram (its size is
bounded by ``capacity`` at any corpus size) into at most a few thousand
patterns with multiplicities, and Spark hands every piece its place from its
running number among the pieces of its length. No group of pieces is gathered
anywhere.

Method. Best-fit decreasing gives the incumbent. If it needs more bins than
the lower bound, bin completion runs depth first: around the largest remaining
piece it enumerates the undominated fillings, best fit first, prunes a branch
when the waste exceeds what an improvement by one bin allows, and takes every
improvement as the new incumbent. Where the search ends without proof, packings
are sought among pattern columns (``columns``), bin completion settling the rest.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import pack_by_columns
from .common import slices, small_batches, written

Pattern = tuple[int, list[tuple[int, int]]]  # multiplicity, [(length, how many)]

MOST_LENGTHS = 400  # different lengths for which pattern columns are worked out
CACHE_WORDS = 1_500_000  # words whose ids a worker remembers; affects speed only

# Characters for which normalisation works letter by letter, so that a word's
# ids do not depend on its neighbours; other texts take the tokenizer whole.
_NOT_PLAIN = regex.compile(r"[^\t\n\v\f\r\x20-\x7e\xa0-\u012f\u0131-\u024f]")
# white space to str.split, but not to the tokenizer; the start of special tokens
_NOT_SPLIT = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
# fixed value: the pattern that the vocabulary's file names for splitting
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if it is printable in Latin-1, else the next code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


class WordTokenizer(dict):
    """Ids of ``Tokenizer.encode(text, add_special_tokens=False)``, remembering
    the ids of white-space separated words between texts."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(definition)
        self.tokenize = self.whole.model.tokenize
        self.letters = _byte_letters()

    def __missing__(self, word: str) -> bytes | None:
        ascii_only = word.isascii()
        if not (ascii_only and word.isprintable()) and _NOT_PLAIN.search(word):
            return None
        lower = word.lower()
        ids: list[int] = []
        for piece in (lower,) if lower.isalpha() else _PIECES.findall(lower):
            if not ascii_only:
                piece = piece.encode().decode("latin-1").translate(self.letters)
            ids += [t.id for t in self.tokenize(piece)]
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids_out = array("I", ids)
        if sys.byteorder == "big":
            ids_out.byteswap()
        self[word] = out = ids_out.tobytes()
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not any(x in text for x in _NOT_SPLIT):
            try:
                return b"".join(map(self.__getitem__, text.split()))
            except TypeError:  # a word with other characters
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, nth): the pieces of each
    document; ``nth`` numbers the pieces of a length within the task ``part``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(definition.value)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for some in slices(batches, "text"):
            rows: list[tuple] = []
            for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                ids = memoryview(tokenizer.encode(text or "") + end)
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc, piece, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["id", "piece", "start", "length", "ids_crc32", "part", "nth"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        work, "id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


# ---------------------------------------------------------------- the packing


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: the volume, or pieces that exclude each
    other with the room that they leave to shorter ones (Martello and Toth's L2)."""
    lengths = np.array(sorted(counts), np.int64)
    if not len(lengths):
        return 0
    n = np.array([counts[x] for x in lengths.tolist()], np.int64)
    best = -(-int((lengths * n).sum()) // capacity)
    for k in lengths[lengths <= capacity // 2].tolist() + [0]:
        big, mid = lengths > capacity - k, (lengths > capacity // 2) & (lengths <= capacity - k)
        small = (lengths >= k) & (lengths <= capacity // 2)
        room = int(((capacity - lengths[mid]) * n[mid]).sum())
        over = max(0, int((lengths[small] * n[small]).sum()) - room)
        best = max(best, int(n[big].sum()) + int(n[mid].sum()) + -(-over // capacity))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over a histogram; equal bins are handled together."""
    open_bins: dict[int, list[Pattern]] = {}

    def put(room: int, n: int, items: list[tuple[int, int]]) -> None:
        if n:
            open_bins.setdefault(room, []).append((n, items))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_bins if r >= length):
            if not left:
                break
            each = room // length
            for n, items in open_bins.pop(room):
                full = min(n, left // each)
                put(room - each * length, full, [*items, (length, each)])
                left, n = left - full * each, n - full
                if n and left and left < each:
                    put(room - left * length, 1, [*items, (length, left)])
                    left, n = 0, n - 1
                put(room, n, items)
        each = capacity // length
        put(capacity - each * length, left // each, [(length, each)])
        if left % each:
            put(capacity - (left % each) * length, 1, [(length, left % each)])
    return [p for group in open_bins.values() for p in group]


def _fillings(lengths: list[int], counts: dict[int, int], room: int, waste: int, most: int) -> list[list[tuple[int, int]]]:
    """Fillings of ``room`` that waste at most ``waste``, best fit first and
    without those dominated by another one found; at most ``most`` of them."""
    found: list[tuple[int, list[tuple[int, int]]]] = []
    least = min((x for x in lengths if counts[x]), default=room + 1)
    steps = 0

    def extend(at: int, room: int, items: list[tuple[int, int]]) -> None:
        nonlocal steps
        steps += 1
        if len(found) >= most or steps > 20 * most:
            return
        while at < len(lengths) and (lengths[at] > room or not counts[lengths[at]]):
            at += 1
        if at == len(lengths) or room < least:
            if room <= waste:
                found.append((room, items))
            return
        length = lengths[at]
        for n in range(min(counts[length], room // length), -1, -1):
            extend(at + 1, room - n * length, [*items, (length, n)] if n else items)
            if len(found) >= most:
                return

    extend(0, room, [])
    found.sort(key=lambda f: (f[0], sum(n for _, n in f[1])))
    kept: list[list[tuple[int, int]]] = []
    flat: list[list[int]] = []
    for _, items in found:
        own = [x for x, n in items for _ in range(n)]
        # a filling of as many pieces, none shorter, dominates
        if not any(len(o) == len(own) and all(a >= b for a, b in zip(o, own)) for o in flat):
            kept.append(items)
            flat.append(own)
    return kept


def bin_completion(counts: dict[int, int], capacity: int, bins: int, nodes: int) -> list[Pattern] | None:
    """A packing into at most ``bins`` bins, or None if there is none or the
    search ends after ``nodes`` nodes."""
    total = sum(x * n for x, n in counts.items())
    lengths, left = sorted(counts, reverse=True), dict(counts)
    if bins * capacity < total:
        return None
    # each frame: waste still allowed, fillings to try, the pattern applied
    stack: list[list] = []
    waste, applied = bins * capacity - total, []
    while nodes > 0:
        nodes -= 1
        top = next((x for x in lengths if left[x]), None)
        if top is None:
            return applied
        left[top] -= 1
        options = _fillings([x for x in lengths if x <= top], left, capacity - top, waste, 64)
        left[top] += 1
        stack.append([waste, iter(options), top])
        while stack:
            waste, options, top = stack[-1]
            if len(applied) == len(stack):  # came back: take the pattern out
                n, items = applied.pop()
                for x, k in items:
                    left[x] += n * k
            items = next(options, None)
            if items is None:
                stack.pop()
                continue
            need = dict(items)
            need[top] = need.get(top, 0) + 1
            spare = capacity - sum(x * k for x, k in need.items())
            n = min(left[x] // k for x, k in need.items())
            n = min(n, waste // spare) if spare else n
            for x, k in need.items():
                left[x] -= n * k
            applied.append((n, sorted(need.items(), reverse=True)))
            waste -= n * spare
            break
        else:
            return None
    return None


def pack(counts: dict[int, int], capacity: int, nodes: int = 1_000, most_lengths: int = MOST_LENGTHS) -> list[Pattern]:
    """Patterns that pack all pieces of the histogram; every piece is always packed.

    Best fit is improved by bin completion until the lower bound is met, which
    proves the packing best, or the search of ``nodes`` nodes ends. Then, for a
    histogram of at most ``most_lengths`` different lengths, pattern columns give
    a tighter bound and further packings.
    """
    best = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    while (used := sum(n for n, _ in best)) > least:
        better = bin_completion(counts, capacity, used - 1, nodes)
        if better is None:
            break
        best = better
    if used > least and len(counts) <= most_lengths:
        finish = lambda rest, bins: bin_completion(rest, capacity, bins, nodes)
        better, _ = pack_by_columns(counts, capacity, used - 1, finish)
        best = better or best
    return best


def _segments(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, by their running number: from ``rank``
    on, ``each`` to a sequence from ``sequence``, the first at ``offset``."""
    rows, used, sequence = [], {}, 0
    for n, items in patterns:
        offset = 0
        for length, each in items:
            rank = used.get(length, 0)
            rows.append((length, rank, each, sequence, offset))
            used[length] = rank + n * each
            offset += length * each
        sequence += n
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "each", "sequence", "offset"), columns))


_RANK_BITS = 45


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and then ``end_id``; only documents
    longer than ``capacity`` are cut. Null and empty texts are a document of
    ``end_id`` alone. A null id stays null; repeated rows are packed as often
    as they occur. An empty table gives an empty result; further columns are
    not read.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = written(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    per_part = rows.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(_segments(pack(counts, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = plan.value
        keys = (s["length"] << _RANK_BITS) | s["rank"]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << _RANK_BITS) | rank, "right") - 1
            nth = rank - s["rank"][at]
            sequence = s["sequence"][at] + nth // s["each"][at]
            offset = s["offset"][at] + nth % s["each"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    ranked = rows.join(first, ["length", "part"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank")
    )
    placed = ranked.mapInArrow(
        place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)
