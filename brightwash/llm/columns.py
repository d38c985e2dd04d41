"""Packings from pattern columns, for where bin completion ends without proof.

The relaxation of packing: use each filling of a sequence (a pattern) any
fractional number of times, so that all pieces are held, with the least total.
Its columns are generated: the simplex multipliers are values of the pieces, and
a knapsack over the capacity finds the filling of the largest value; when none is
worth more than one sequence the relaxation is solved, and its total rounded up
is a lower bound. A packing follows by diving: patterns that the solution uses
whole times are taken, else the one that it uses most, and the rest is solved
again, until bin completion settles what is left.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Pattern = tuple[int, list[tuple[int, int]]]
_SLACK = 1e-7
SURE = 0.95  # share of a use above which a pattern is taken along with others


def best_pattern(lengths: np.ndarray, most: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The filling of the largest total value with at most ``most`` of each length."""
    best, taken = np.zeros(capacity + 1), []
    for i in np.flatnonzero(values > 1e-9).tolist():
        left, n = min(int(most[i]), capacity // int(lengths[i])), 1
        while left > 0:  # 1, 2, 4 ... of a piece, so that any number can be reached
            n = min(n, left)
            left -= n
            size = n * int(lengths[i])
            with_it = best[: capacity + 1 - size] + values[i] * n
            gain = with_it > best[size:] + 1e-9
            np.copyto(best[size:], with_it, where=gain)
            taken.append((i, n, size, gain))
            n *= 2
    pattern, room = np.zeros(len(lengths)), capacity
    for i, n, size, gain in reversed(taken):
        if room >= size and gain[room - size]:
            pattern[i] += n
            room -= size
    return float(best[capacity]), pattern


def relaxation(lengths: np.ndarray, need: np.ndarray, capacity: int, known: np.ndarray, seed: int):
    """(total, patterns, uses, new columns) of the solved relaxation; ``known``
    holds columns to begin with, one a row."""
    size = len(lengths)
    most = np.minimum(need, capacity // lengths)
    basis, inverse, cost = np.diag(most.astype(float)), np.diag(1.0 / most), np.ones(size)
    # a little more of each piece, so that no two solutions tie and the steps cannot go in circles
    uses = inverse @ (need * (1 + 1e-6 * np.random.default_rng(seed).random(size)))
    first = len(known)
    while True:
        value = cost @ inverse
        over = int(np.argmin(value))
        at = int(np.argmax(known @ value)) if len(known) else -1
        if value[over] < -_SLACK:  # more of a piece than there is, for nothing
            column, price = -np.eye(size)[over], 0.0
        elif at >= 0 and known[at] @ value > 1 + _SLACK:
            column, price = known[at], 1.0
        else:
            worth, column = best_pattern(lengths, most, value, capacity)
            if worth <= 1 + _SLACK:
                break
            known, price = np.vstack([known, column]), 1.0
        change = inverse @ column
        rows = np.flatnonzero(change > 1e-9)
        row = int(rows[np.argmin(uses[rows] / change[rows])])
        step = uses[row] / change[row]
        uses -= step * change
        uses[row] = step
        pivot = inverse[row] / change[row]
        inverse -= np.outer(change, pivot)
        inverse[row], basis[:, row], cost[row] = pivot, column, price
    exact = inverse @ need
    return float(cost @ exact), basis[:, cost > 0].T, exact[cost > 0], known[first:]


def _dive(counts: dict[int, int], capacity: int, pool: list[np.ndarray], seed: int, at_most: int, finish: Callable):
    """(packing of at most that many sequences or None, lower bound)."""
    lengths = np.array(sorted(counts, reverse=True), np.int64)
    left = np.array([counts[x] for x in lengths.tolist()], np.int64)
    out: list[Pattern] = []
    bound = used = 0
    while left.any():
        on = np.flatnonzero(left)
        if out and left.sum() <= 60:
            rest = finish({int(lengths[i]): int(left[i]) for i in on}, at_most - used)
            if rest is not None:
                return out + rest, bound
        known = [p[on] for p in pool if p.sum() == p[on].sum() and (p[on] <= left[on]).all()]
        total, patterns, uses, new = relaxation(lengths[on], left[on], capacity, np.array(known).reshape(-1, len(on)), seed)
        for column in new:
            whole = np.zeros(len(lengths))
            whole[on] = column
            pool.append(whole)
        bound = bound or int(np.ceil(total - 1e-4))
        if used + int(np.ceil(total - 1e-4)) > at_most:
            return None, bound
        taken = 0
        for j in np.argsort(-uses, kind="stable").tolist():
            pattern = patterns[j].astype(np.int64)
            if taken and (uses[j] <= SURE or (pattern > left[on]).any()):
                continue
            pattern = np.minimum(pattern, left[on])
            held = pattern > 0
            if held.any():
                n = int(min(max(1, int(uses[j] + 1e-6)), (left[on][held] // pattern[held]).min()))
                out.append((n, [(int(lengths[on[i]]), int(pattern[i])) for i in np.flatnonzero(held)]))
                left[on] -= n * pattern
                used, taken = used + n, taken + 1
    return (out if used <= at_most else None), bound


def pack_by_columns(counts: dict[int, int], capacity: int, at_most: int, finish: Callable, tries: int = 3) -> tuple[list[Pattern] | None, int]:
    """The best packing found into at most ``at_most`` sequences (None if none
    was), and a lower bound. ``finish(counts, bins)`` packs a small rest or
    returns None. Each try dives from another of the equal solutions and keeps
    the columns of those before."""
    pool: list[np.ndarray] = []
    best, bound = None, 0
    for seed in range(tries):
        found, bound = _dive(counts, capacity, pool, seed, at_most, finish)
        if found is not None:
            best, at_most = found, sum(n for n, _ in found) - 1
        if at_most < bound:
            break
    return best, bound
