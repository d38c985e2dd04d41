"""Benchmark passages in documents, found through the CGK embedding.

The embedding (Chakraborty, Goldenberg, Koucky) walks along a string: at each
step it writes the byte it stands on, and a random function of step and byte
says whether to move on. Walks over two strings that differ by an edit tend to
fall in step again, so a small edit distance becomes a small Hamming distance.
Bit-sampling LSH then hashes a few random positions of the walk; several
independent walks and samples (their number is set by the recall measured on
held-out edits at the threshold of passages from the whole block; one that is
not reached is warned of) give the candidates.

A hit is kept if walks from it to both ends of the item agree in more than
``AGREEMENT`` of their steps, the Hamming side of the embedding; the measured
recall includes this test.

Every text is cut into windows that start a third of the shortest item apart,
at most ``MOST_STRIDE`` bytes;
every byte of an item starts a window of its own. So each item-sized stretch of
a text holds windows that line up with windows of the item. A hit places the
item in the text; its item-sized window there is verified by exact edit
distance, after a lossless count of shared q-grams.

The benchmark is the stated query set: it is broadcast in blocks of bounded
size, each compared with all documents in a map-only job.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, slices, small_batches, utf8_values, written

STEPS = 32  # of a walk over items of 64 bytes or more; shorter items walk half their bytes
SAMPLED = 12  # positions of the walk that are hashed
MOST_REPEATS = 128  # tables; fewer than the recall takes are reported
RECALL_EDITS = 200  # edited items that the recall is measured on, from the whole block
MOST_STRIDE = 8  # bytes between the windows of a text; wider ones take many more tables
DRAWS = 6
AGREEMENT = 0.3  # share of equal steps; walks over unrelated prose have about 0.2
LONG_WALK = 256  # steps of the walks that are compared
BLOCK_BYTES = 1 << 18  # of item text in one broadcast
BLOCKS_IN_A_STAGE = 4
_FILTER_BITS = 20
_Q = 4

_FOLD = np.full(256, 32, np.uint8)
for _b in range(256):
    if chr(_b).isascii() and chr(_b).isalnum():
        _FOLD[_b] = ord(chr(_b).lower())
    elif _b >= 128:
        _FOLD[_b] = _b


def normalised(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits in lower case with single spaces between, and each
    byte's place in the text."""
    raw = np.frombuffer(text, np.uint8)
    folded = _FOLD[raw]
    # capital letters of Latin-1 in UTF-8: C3 80 to C3 9E, but for the sign C3 97
    capital = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
    folded[capital] += 0x20
    keep = np.flatnonzero((folded != 32) | np.r_[False, folded[:-1] != 32]) if len(raw) else np.empty(0, np.int64)
    if len(keep) and folded[keep[-1]] == 32:
        keep = keep[:-1]
    return folded[keep], keep


def edit_distance_within(item: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(distance, end): the least edit distance of ``item`` to a substring of
    ``text`` and where the first such substring ends, if at most ``most``.
    Bit-parallel columns of the dynamic programme (Myers)."""
    n = len(item)
    mask, high = (1 << n) - 1, 1 << (n - 1)
    places: dict[int, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    plus, minus, score = mask, 0, n
    best, end = n, 0  # the empty substring
    for j, c in enumerate(text):
        eq = places.get(c, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(d | plus) & mask
        down = plus & d
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1 & mask, down << 1 & mask
        plus, minus = (down | ~(x | up)) & mask, up & x
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


def _grams(text: bytes) -> Counter:
    return Counter(text[i : i + _Q] for i in range(len(text) - _Q + 1))


class ItemIndex:
    """LSH tables over one block of items of similar length."""

    def __init__(self, items: list[tuple[int, np.ndarray]], similarity: float, recall: float, seed: int = 7):
        self.similarity = similarity
        self.ids = [i for i, _ in items]
        self.texts = [t.tobytes() for _, t in items]
        self.grams = [_grams(t) for t in self.texts]
        shortest = min(map(len, self.texts))
        self.stride = max(1, min(shortest // 3, MOST_STRIDE))
        self.steps = max(2, min(STEPS, shortest // 2))
        self.random = np.random.default_rng(seed)
        sizes = np.array([len(t) for t in self.texts])
        self.data = np.frombuffer(b"".join(t + bytes(self.steps) for t in self.texts), np.uint8)
        begin = np.cumsum(sizes + self.steps) - sizes - self.steps
        # a window at each byte that leaves half a walk of item behind it
        count = np.maximum(1, sizes - self.steps // 2)
        self.item = np.repeat(np.arange(len(items)), count)
        self.offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.starts = begin[self.item] + self.offset
        self.begin, self.end = begin[self.item], begin[self.item] + sizes[self.item]
        self.long_moves = self.random.integers(0, 2, (2, LONG_WALK, 256))
        self.tables: list[tuple] = []
        self.bits: list[np.ndarray] = []
        # tables are added until edits that none was added for are found often
        # enough; edits that are not join those that more tables are added for
        chosen = np.linspace(0, len(items) - 1, max(RECALL_EDITS, min(len(items), 2 * RECALL_EDITS))).astype(int).tolist()
        left, edits = [], 0
        while True:
            fresh = [(i, self._edited(self.texts[i])) for i in chosen]
            missed = [x for x in fresh if not any(self._hit(*x, t) for t in range(len(self.tables)))]
            self.recall = 1 - len(missed) / len(fresh)
            if self.recall >= recall and self.tables:
                break
            left, edits = left + missed, edits + len(fresh)
            if len(self.tables) >= MOST_REPEATS:
                warnings.warn(
                    f"items of {shortest} to {sizes.max()} bytes: {len(self.tables)} tables find {self.recall:.3f} "
                    f"of edited items, {recall} were asked for"
                )
                break
            while len(self.tables) < MOST_REPEATS and (not self.tables or len(left) > (1 - recall) * edits):
                self._add_table()
                left = [x for x in left if not self._hit(*x, len(self.tables) - 1)]

    def _most(self, item: int) -> int:
        return int(len(self.texts[item]) * (1 - self.similarity) + 1e-9)

    def _edited(self, text: bytes) -> np.ndarray:
        """The text with random edits at the threshold, between other bytes."""
        letters = np.frombuffer(text, np.uint8)
        pad = lambda n: bytes(self.random.choice(letters, n))
        out = bytearray(text)
        for _ in range(int(len(text) * (1 - self.similarity))):
            at, kind = int(self.random.integers(len(out))), int(self.random.integers(3))
            out[at : at + (kind != 1)] = b"" if kind == 2 else pad(1)
        return np.frombuffer(pad(int(self.random.integers(self.stride, 2 * self.stride + 1))) + bytes(out) + pad(self.steps), np.uint8)

    def _hit(self, item: int, text: np.ndarray, table: int) -> bool:
        windows = np.arange(0, len(text), self.stride)
        window, found = self._lookup(table, text, windows)
        own = self.item[found] == item
        return bool(self._agree(text, windows[window[own]], found[own]).any())

    def _add_table(self) -> None:
        """Of a few random walks take the one that tells the items' own windows
        apart best: some stand still for long and would let much prose pass."""
        best = None
        for _ in range(DRAWS):
            moves = self.random.integers(0, 2, (self.steps, 256))
            # one random position in each of SAMPLED equal stretches of the walk
            sampled = np.zeros(self.steps, bool)
            strata = np.linspace(0, self.steps, min(SAMPLED, self.steps) + 1).astype(int)
            sampled[self.random.integers(strata[:-1], strata[1:])] = True
            keys = self._keys(moves, sampled, self.data, self.starts)
            distinct = len(np.unique(keys))
            if best is None or distinct > best[0]:
                best = distinct, moves, sampled, keys
        _, moves, sampled, keys = best
        order = np.argsort(keys, kind="stable")
        self.tables.append((moves, sampled, keys[order], order.astype(np.int32)))

    def _bits(self, table: int) -> np.ndarray:
        """Which upper parts of hashes a table holds; made where it is used, as
        it would be most of what is broadcast."""
        while len(self.bits) <= table:
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[self.tables[len(self.bits)][2] >> np.uint64(64 - _FILTER_BITS)] = True
            self.bits.append(bits)
        return self.bits[table]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"bits": []}

    @staticmethod
    def _keys(moves: np.ndarray, sampled: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hash of the sampled positions of each window's walk; zero bytes
        follow the data."""
        padded = np.concatenate([data, np.zeros(len(moves) + 1, np.uint8)])
        at = starts.astype(np.int64)
        key = np.full(len(starts), 0x9E3779B97F4A7C15, np.uint64)
        byte, step = np.empty(len(starts), np.uint8), np.empty(len(starts), np.int64)
        for move, take in zip(moves, sampled):
            np.take(padded, at, out=byte, mode="wrap")
            if take:
                key ^= byte
                key *= np.uint64(0x9FB21C651E98DF25)
                key ^= key >> np.uint64(32)
            at += np.take(move, byte, out=step, mode="wrap")
        return key * np.uint64(0xD6E8FEB86659FD93)

    def _lookup(self, table: int, data: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the text's and of the item's windows with equal hashes."""
        moves, sampled, keys, order = self.tables[table]
        own = self._keys(moves, sampled, data, windows)
        some = np.flatnonzero(self._bits(table)[own >> np.uint64(64 - _FILTER_BITS)])
        low, high = np.searchsorted(keys, own[some], "left"), np.searchsorted(keys, own[some], "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(some, n), order[at]

    def _agree(self, data: np.ndarray, windows: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Whether the long walks from each hit, forward and backward, over the
        text and over the item agree often enough."""
        padded = np.concatenate([data, np.zeros(1, np.uint8)])
        equal, steps = np.zeros(len(hits), np.int32), np.zeros(len(hits), np.int32)
        for forward, moves in zip((True, False), self.long_moves):
            x, y = windows.astype(np.int64) - (not forward), self.starts[hits] - (not forward)
            live = np.arange(len(hits))
            for move in moves:
                inside = (y < self.end[hits[live]]) if forward else (y >= self.begin[hits[live]])
                live, x, y = live[inside], x[inside], y[inside]
                if not len(live):
                    break
                a, b = padded[np.clip(x, -1, len(data))], self.data[y]
                equal[live] += a == b
                steps[live] += 1
                x, y = (x + move[a], y + move[b]) if forward else (x - move[a], y - move[b])
        return equal > AGREEMENT * steps

    def matches(self, texts: list[np.ndarray]) -> list[dict[int, tuple[int, int, int]]]:
        """For each normalised text: item -> (distance, start, end) of its best
        passage, the first of equally good ones."""
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        sizes = np.array([len(t) + self.steps for t in texts], np.int64)
        if not sizes.sum():
            return out
        data = np.concatenate([x for t in texts for x in (t, np.zeros(self.steps, np.uint8))])
        begin = np.cumsum(sizes) - sizes
        n = -(-(sizes - self.steps) // self.stride)
        row = np.repeat(np.arange(len(texts)), n)
        windows = begin[row] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * self.stride
        found = np.unique(
            np.concatenate([w * len(self.starts) + h for w, h in (self._lookup(t, data, windows) for t in range(len(self.tables)))])
        )
        window, hit = found // len(self.starts), found % len(self.starts)
        keep = self._agree(data, windows[window], hit)
        window, hit = window[keep], hit[keep]
        place = windows[window] - begin[row[window]] - self.offset[hit]
        places: dict[tuple[int, int], list[int]] = {}
        for r, item, place in sorted(zip(row[window].tolist(), self.item[hit].tolist(), place.tolist())):
            near = places.setdefault((r, item), [])
            if not near or place > near[-1] + max(1, self._most(item) // 2):
                near.append(place)
        for (r, item), near in places.items():
            for place in near:
                got = self._verify(texts[r], item, place)
                if got and (item not in out[r] or got[0] < out[r][item][0]):
                    out[r][item] = got
        return out

    def _verify(self, text: np.ndarray, item: int, place: int) -> tuple[int, int, int] | None:
        wanted, most = self.texts[item], self._most(item)
        slack = most + max(1, most // 2)
        low = max(0, place - slack)
        region = text[low : place + len(wanted) + slack].tobytes()
        need = len(wanted) - _Q + 1 - _Q * most
        if need > 0:
            have = self.grams[item]
            shared = sum(min(n, have[g]) for g, n in _grams(region).items() if g in have)
            if shared < need:
                return None
        got = edit_distance_within(wanted, region, most)
        if got is None:
            return None
        back = edit_distance_within(wanted[::-1], region[: got[1]][::-1], most)
        return got[0], low + got[1] - back[1], low + got[1]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, similarity: float, recall: float) -> Iterator[ItemIndex]:
    """Indexes over blocks of items of similar length (they double from class
    to class). Items without a letter or digit, or with a null text, are in none."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    held: list[tuple[int, np.ndarray]] = []
    size, kind = 0, None
    ordered = rows.filter("text is not null").orderBy(F.ceil(F.log2(F.octet_length("text") + 1)), "id", "text")
    for r in ordered.toLocalIterator():
        text, _ = normalised(r["text"].encode())
        if not len(text):
            continue
        own = int(len(text)).bit_length()
        if held and (own != kind and kind < 7 or size > BLOCK_BYTES):
            yield ItemIndex(held, similarity, recall)
            held, size = [], 0
        kind = own
        held.append((r["id"], text))
        size += len(text)
    if held:
        yield ItemIndex(held, similarity, recall)


_MATCH = T.ArrayType(
    T.StructType(
        [T.StructField("item_id", T.LongType())] + [T.StructField(c, T.IntegerType()) for c in ("distance", "item_bytes", "start", "end")]
    )
)
_ARROW_MATCH = pa.list_(
    pa.struct([("item_id", pa.int64()), *((c, pa.int32()) for c in ("distance", "item_bytes", "start", "end"))])
)


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
    recall: float = 0.97,
) -> DataFrame:
    """``docs`` with its columns and ``matches``: the items that each text holds
    within an edit distance of 1 - ``similarity`` of the item's bytes (both
    normalised), with the distance and the bytes of the text that match.

    Null and empty texts match nothing; repeated rows match alike; with an
    empty benchmark nothing matches. A column named matches is replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("matches", "__text")]
    out = docs.select(*[docs[c] for c in kept], F.lit(None).cast(_MATCH).alias("matches"))
    for n, index in enumerate(item_blocks(benchmark, item_id, item_text, similarity, recall), 1):
        out = _with_block(out, kept, text_col, index)
        if n % BLOCKS_IN_A_STAGE == 0:  # each block in a stage is a Python process of its task
            out = written(out, "matched")
    return out.withColumn("matches", F.coalesce("matches", F.array().cast(_MATCH)))


def _with_block(docs: DataFrame, kept: list[str], text_col: str, index: ItemIndex) -> DataFrame:
    shared = Shared(docs.sparkSession, index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.get()
        for part in slices(batches, "__text"):
            texts, places = zip(*map(normalised, utf8_values(part.column(len(kept) + 1))))
            found = []
            for before, own, place in zip(part.column(len(kept)).to_pylist(), index.matches(list(texts)), places):
                new = [
                    {"item_id": index.ids[i], "distance": d, "item_bytes": len(index.texts[i]), "start": int(place[a]), "end": int(place[b - 1]) + 1}
                    for i, (d, a, b) in sorted(own.items())
                ]
                found.append((before or []) + new)
            columns = [*part.columns[: len(kept)], pa.array(found, _ARROW_MATCH)]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[: len(kept)], "matches"])

    rows = docs.select(*kept, "matches", F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(work, docs.select(*kept, "matches").schema)
