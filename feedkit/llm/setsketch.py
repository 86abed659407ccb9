"""SetSketch registers: truncated minima of exponential variates on a geometric scale.

Every element of a set sends out a Poisson process of points; each point falls on one of ``m``
registers at random.  The first points to reach the registers are independent exponential
variates, so a register's least point over a set is exponential with the set's size as rate,
registers of a union are minima of registers, and two sets share a register's point with
probability equal to their Jaccard similarity.  A register keeps only the place of its minimum
on the scale ``BASE ** -k``.
"""

from __future__ import annotations

import numpy as np

from feedkit.llm.words import mix

BASE = 1.02
M, ROWS = 258, 6
BANDS = M // ROWS
_LOW, _HIGH = -600, 2400
_STEP = np.uint64(0xD1342543DE82EF95)


def minima(elements: np.ndarray, at: np.ndarray, m: int = M) -> np.ndarray:
    """The least point of each register for each set (rows), infinity for an empty set.

    All sets go forward together.  An element drops out once its next point lies beyond every
    register of its set, after a few points in a large set.
    """
    n_sets = len(at) - 1
    best = np.full(n_sets * m, np.inf, dtype=np.float64)
    sizes = np.diff(at)
    home = np.repeat(np.arange(n_sets), sizes)
    state, point = elements.copy(), np.zeros(len(elements))
    turn = np.zeros(len(elements), dtype=np.uint64)
    while len(state):
        # few elements left: take many points of each at once
        many = int(np.clip(16384 // len(state), 1, 4 * m))
        turns = turn[:, None] + np.arange(1, many + 1, dtype=np.uint64)[None, :]
        bits = mix(state[:, None] + turns * _STEP)
        gap = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
        points = point[:, None] + np.cumsum(gap, axis=1)
        target = (mix(bits ^ _STEP) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
        np.minimum.at(best, (home[:, None] * m + target.astype(np.int64)).ravel(), points.ravel())
        point, turn = points[:, -1], turns[:, -1]
        limit = best.reshape(n_sets, m).max(axis=1)
        going = point <= limit[home]
        state, point, turn, home = state[going], point[going], turn[going], home[going]
    return best.reshape(n_sets, m)


def registers(elements: np.ndarray, at: np.ndarray, m: int = M) -> np.ndarray:
    """Truncated registers as 16-bit integers; an empty set has the lowest value."""
    least = minima(elements, at, m)
    with np.errstate(divide="ignore"):
        place = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(place, _LOW, _HIGH).astype(np.int16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def bands(regs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for every band of ``rows`` registers."""
    n, m = regs.shape
    parts = regs.reshape(n, m // rows, rows).astype(np.uint64)
    key = np.arange(1, m // rows + 1, dtype=np.uint64)[None, :] * _STEP
    key = np.broadcast_to(key, (n, m // rows)).copy()
    for k in range(rows):
        key = mix(key + parts[:, :, k] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from registers and exact set sizes.

    With shares u and v of the summed sizes, a register of the first set is higher with
    probability p(u - vJ), of the second with p(v - uJ), where p(x) = -log(1 - x(b-1)/b) / log b.
    The log-likelihood of the counts of higher, lower and equal registers is concave in J;
    bisection on its slope finds the maximum.
    """
    up = (a > b).sum(axis=1).astype(np.float64)
    down = (a < b).sum(axis=1).astype(np.float64)
    same = a.shape[1] - up - down
    total = np.maximum(size_a + size_b, 1).astype(np.float64)
    u, v = size_a / total, size_b / total
    c = (BASE - 1) / BASE

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * c) / np.log(BASE)

    def slope(j):
        pu, pv = p(u - v * j), p(v - u * j)
        du = -v * c / (1 - np.clip(u - v * j, 0, 1) * c) / np.log(BASE)
        dv = -u * c / (1 - np.clip(v - u * j, 0, 1) * c) / np.log(BASE)
        tiny = 1e-12
        return up * du / np.maximum(pu, tiny) + down * dv / np.maximum(pv, tiny) \
            - same * (du + dv) / np.maximum(1 - pu - pv, tiny)

    low = np.zeros(len(a))
    high = np.minimum(u / np.maximum(v, 1e-12), v / np.maximum(u, 1e-12))
    for _ in range(40):
        middle = (low + high) / 2
        rising = slope(middle) > 0
        low, high = np.where(rising, middle, low), np.where(rising, high, middle)
    return (low + high) / 2
