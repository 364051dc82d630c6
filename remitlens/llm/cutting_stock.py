"""Cutting stock by column generation: how to fill bins of one capacity from a histogram of sizes.

All matrix work is element-wise numpy. A threaded BLAS or LAPACK call may wait for ever in a process that runs a Spark
driver, and matrices of a few hundred classes need none.
"""

from __future__ import annotations

import numpy as np

Pattern = dict[int, int]


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of one bin, any size any number of times, by dynamic programming over capacity."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, "right")
        value[room] = value[room - 1]
        if fits:
            found = prices[:fits] + value[room - sizes[:fits]]
            best = int(found.argmax())
            if found[best] > value[room]:
                value[room], choice[room] = found[best], best
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return value[capacity], counts


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination of one column after the other, the largest entry as pivot."""
    n = len(matrix)
    rows = np.hstack([matrix.astype(float), np.eye(n)])
    for i in range(n):
        best = i + int(np.abs(rows[i:, i]).argmax())
        if best != i:
            rows[[i, best]] = rows[[best, i]]
        rows[i] /= rows[i, i]
        others = np.flatnonzero(rows[:, i])
        others = others[others != i]
        rows[others] -= rows[others, i, None] * rows[i]
    return rows[:, n:]


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, fractions allowed, with the fewest bins.

    Revised simplex. The basis starts with one pattern per size, and each knapsack adds the pattern that saves most at
    the current prices, until none saves anything. ``pivots`` bounds the steps: each basis on the way fills every
    demand, so an early end only costs bins.
    """
    each = capacity // sizes
    basis, used = np.diag(each).astype(float), demand / each
    inverse = np.diag(1.0 / each)
    for step in range(1, steps + 1):
        worth, pattern = best_pattern(sizes, inverse.sum(0), capacity)
        if worth <= 1 + gap:
            break
        held = np.flatnonzero(pattern)
        change = (inverse[:, held] * pattern[held]).sum(1)
        grows = change > 1e-9
        if not grows.any():
            break
        until = np.full(len(sizes), np.inf)
        until[grows] = used[grows] / change[grows]
        out = int(until.argmin())
        used = np.maximum(used - until[out] * change, 0.0)
        used[out] = until[out]
        basis[:, out] = pattern
        if step % 128 == 0:
            # Rounding errors of the updates add up, so the basis is inverted anew now and then.
            inverse = inverse_of(basis)
            used = np.maximum((inverse * demand).sum(1), 0.0)
        else:
            row = inverse[out] / change[out]
            inverse = inverse - np.outer(change, row)
            inverse[out] = row
    return basis, used


def rest_patterns(left: Pattern, capacity: int) -> list[tuple[Pattern, int]]:
    """Bins for what rounding leaves: the largest size that fits, again and again."""
    found = []
    left = {size: n for size, n in left.items() if n > 0}
    while left:
        room, pattern = capacity, {}
        for size in sorted(left, reverse=True):
            if take := min(left[size], room // size):
                pattern[size] = take
                room -= take * size
        times = min(left[size] // n for size, n in pattern.items())
        found.append((pattern, times))
        left = {size: n - times * pattern.get(size, 0) for size, n in left.items()}
        left = {size: n for size, n in left.items() if n}
    return found


def cutting_stock(demand: Pattern, capacity: int, gap: float = 0.001, steps: int = 10_000) -> list[tuple[Pattern, int]]:
    """Patterns and whole numbers of bins that hold every size (1 to capacity) as often as ``demand`` says.

    ``gap`` is the saving per bin below which no more patterns are sought, ``steps`` the most patterns that are.
    """
    demand = {size: n for size, n in demand.items() if n > 0}
    if not demand:
        return []
    sizes = np.array(sorted(demand))
    wanted = np.array([demand[s] for s in sizes], float)
    basis, used = relaxed(sizes, wanted, capacity, gap, steps)
    found, left = [], dict(demand)
    for column, times in zip(basis.T, used, strict=True):
        pattern = {int(sizes[i]): int(round(column[i])) for i in np.flatnonzero(column > 0.5)}
        whole = min([int(times + 1e-6), *[left[size] // n for size, n in pattern.items()]])
        if whole > 0:
            found.append((pattern, whole))
            for size, n in pattern.items():
                left[size] -= whole * n
    return found + rest_patterns(left, capacity)
