"""SetSketch: registers of exponentially spaced, truncated minima of a set.

Register i of a set holds ``floor(1 - log_b(min over elements of h_i))`` with h_i
exponentially distributed. The register of a union is the larger of the two, so sketches
merge, and equal registers become likelier the more two sets share, so bands of them find
similar sets (O. Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog", 2021).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .words import mix

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Shape(NamedTuple):
    """``registers`` is a prime of at least ``bands * rows``."""

    registers: int = 367
    bands: int = 61
    rows: int = 6
    base: float = 1.02


def sketches(keys: np.ndarray, counts: np.ndarray, shape: Shape) -> np.ndarray:
    """Registers (sets x registers, int16) of sets that lie one after another in ``keys``.

    An element's values ascend: spacing j is exponential with rate (registers - j + 1), and
    the registers they go to are a random cycle through all of them. An element is done as
    soon as its next value exceeds every register of its set, so that the work for a set of
    n elements is near n + registers * log(registers) and not n * registers.
    """
    size = shape.registers
    sets = len(counts)
    least = np.full((sets, size), np.inf, np.float32)
    flat = least.reshape(-1)
    owner = np.repeat(np.arange(sets), counts)
    seed = mix(keys ^ _GOLDEN)
    place = (seed >> np.uint64(33)).astype(np.int64) % size
    step = ((seed & np.uint64(0x7FFFFFFF)).astype(np.int64) % (size - 1)) + 1
    value = np.zeros(len(keys), np.float32)
    state = seed
    for j in range(size):
        if not len(state):
            break
        state = state + _GOLDEN
        uniform = ((mix(state) >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-24)
        value = value - np.log(uniform) / np.float32(size - j)
        at = owner * size + place
        np.minimum.at(flat, at, value)
        place = place + step
        place[place >= size] -= size
        # The limit only sinks, so it is enough to look now and then once few are left.
        if j < 8 or j % 8 == 0:
            alive = value < least.max(axis=1)[owner]
            if not alive.all():
                state, value, owner, place, step = state[alive], value[alive], owner[alive], place[alive], step[alive]
    with np.errstate(divide="ignore"):
        levels = np.floor(1.0 - np.log(least) / np.log(shape.base))
    return np.clip(levels, -32000, 32000).astype(np.int16)


def band_keys(registers: np.ndarray, shape: Shape) -> np.ndarray:
    """One 64-bit key per set and band (sets x bands)."""
    keys = np.empty((len(registers), shape.bands), np.uint64)
    values = registers.astype(np.int64).astype(np.uint64)
    for band in range(shape.bands):
        key = np.full(len(registers), band + 1, np.uint64)
        for row in range(shape.rows):
            key = mix(key + values[:, band * shape.rows + row] * _GOLDEN)
        keys[:, band] = key
    return keys


def can_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float, base: float, z: float = 6.0) -> np.ndarray:
    """Whether a similarity of ``least`` or more is credible for pairs of sketches.

    The joint likelihood of the counts of larger, smaller and equal registers, given the
    sizes of both sets, is a function of the similarity alone. A pair is given up only if
    its maximum lies below ``least`` and the likelihood ratio speaks against ``least`` by
    more than ``z`` standard deviations.
    """
    larger = (a > b).sum(axis=1)[:, None]
    smaller = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - larger - smaller
    total = (n_a + n_b).astype(np.float64)
    u, v = (n_a / total)[:, None], (n_b / total)[:, None]
    highest = np.minimum(u / v, v / u)
    grid = np.linspace(0.0, 1.0, 101)[None, :] * highest

    def log_likelihood(similarity: np.ndarray) -> np.ndarray:
        up = _chance(u - v * similarity, base)
        down = _chance(v - u * similarity, base)
        same = np.maximum(1.0 - up - down, 1e-12)
        return larger * np.log(np.maximum(up, 1e-12)) + smaller * np.log(np.maximum(down, 1e-12)) + equal * np.log(same)

    curve = log_likelihood(grid)
    best = curve.max(axis=1)
    estimate = np.take_along_axis(grid, curve.argmax(axis=1)[:, None], 1)[:, 0]
    at_least = log_likelihood(np.minimum(np.full_like(highest, least), highest))[:, 0]
    possible = np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b) - 1e-9
    return possible & ((estimate >= least) | (2.0 * (best - at_least) <= z * z))


def _chance(x: np.ndarray, base: float) -> np.ndarray:
    """Probability that one register exceeds the other."""
    return -np.log1p(-np.maximum(x, 0.0) * (base - 1.0) / base) / np.log(base)
