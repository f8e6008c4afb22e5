"""Repeats of nearby words, tile by tile.

Periods are taken by octave: those from s to 2s - 1, s a power of two. A word sequence is cut
into segments of s words. A stretch that repeats at least four times with such a period
agrees with itself, shifted by the period, over two whole segments in a row, and reaches every
border between them. So the borders of such segments are looked at, each in a tile of four
segments: how far the tile agrees with its own shift, from the border forward and backward,
are values of the Z-function of two short strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .segments import pieces
from .words import SPACES, mix, words_of


def word_keys(text: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit key) of the words of texts that lie one after another.

    A text beyond ``limit`` is worked through in pieces of that size.
    """
    if len(offsets) == 2 and len(text) > limit:
        parts = [_plain_keys(np.frombuffer(piece, np.uint8), np.array([0, len(piece)])) for piece in pieces(text.tobytes(), limit)]
        return tuple(np.concatenate(side) for side in zip(*parts, strict=True))
    return _plain_keys(text, offsets)


def _plain_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(data, offsets, SPACES)
    # Words that differ in capitals only share a key there: a sum over the capitals parts them.
    capital = np.zeros(len(data) + 1, np.uint64)
    is_capital = (data >= 0x41) & (data <= 0x5A)
    if not is_capital.any():
        return words.doc, words.key
    place = np.arange(len(data), dtype=np.uint64)
    np.cumsum(np.where(is_capital, np.uint64(1), np.uint64(0)), out=capital[1:])
    has = capital[words.end] != capital[words.start]
    key = words.key.copy()
    at = np.flatnonzero(is_capital)
    owner = np.searchsorted(words.start, at, side="right") - 1
    marks = mix((place[at] - words.start[owner].astype(np.uint64)) + np.uint64(0x51ED2701))
    extra = np.zeros(len(key), np.uint64)
    np.add.at(extra, owner, marks)
    key[has] = mix(key[has] ^ extra[has])
    return words.doc, key


def borders(keys: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(s, borders) for the octaves up to periods of ``longest``.

    ``borders`` are multiples of s beside two segments in a row that seem to agree with
    a shift by one and the same period. Three words of each segment are compared; none that
    agrees as a whole is left out.
    """
    size = len(keys)
    s = 1
    while s <= longest and 3 * s <= size:
        rows = -(-size // s) + 2
        padded = np.concatenate((keys, np.zeros(rows * s + s - size, np.uint64)))
        first = padded[: rows * s].reshape(rows, s)
        agree = first[:-1, :1] == first[1:]
        for offset in {s // 2, s - 1} - {0}:
            shifted = padded[offset : offset + rows * s].reshape(rows, s)
            agree &= first[:-1, offset : offset + 1] == shifted[1:]
        both = np.flatnonzero((agree[:-1] & agree[1:]).any(axis=1))
        if len(both):
            found = np.unique(np.concatenate((both, both + 1, both + 2))) * s
            yield s, found[found < size]
        s *= 2


def z_values(text: list[int]) -> list[int]:
    """For each place, how long the text from there agrees with its own beginning."""
    size = len(text)
    values = [size] + [0] * (size - 1)
    left = right = 0
    for k in range(1, size):
        own = min(right - k, values[k - left]) if k < right else 0
        while k + own < size and text[own] == text[k + own]:
            own += 1
        values[k] = own
        if k + own > right:
            left, right = k, k + own
    return values


def agreements(tile: list[int], before: int, s: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the agreements at the border ``before`` words into a tile.

    ``tile`` holds the words from ``before`` <= s words before the border to 3s after it, or to the end
    of the document. A word at start <= x < end equals the one a period later; places are
    relative to the border. Only stretches that fill a whole segment on one side are returned.
    """
    ahead = tile[before:]
    forward = z_values(ahead)
    if before:
        # Backward: the words before the border against all up to 2s after it, both reversed.
        back = tile[:before][::-1]
        whole = tile[: before + 2 * s][::-1]
        reach = z_values([*back, -1, *whole])
        shift = 1 + len(whole)
    found = []
    for period in range(s, min(2 * s, len(ahead) + 1)):
        onward = min(s, forward[period]) if period < len(ahead) else 0
        backward = min(before, reach[shift - period]) if before else 0
        if onward == s or backward == s:
            found.append((period, -backward, onward))
    return found


def joined(rows: np.ndarray) -> np.ndarray:
    """Rows (document, period, start, end), with those that touch or overlap made one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    group = np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
    # Ends are raised by group, so that a running maximum never crosses into the next.
    number = np.cumsum(group) - 1
    span = int(rows[:, 3].max()) + 1
    reach = np.maximum.accumulate(rows[:, 3] + number * span) - number * span
    new = group.copy()
    new[1:] |= rows[1:, 2] > reach[:-1]
    starts = np.flatnonzero(new)
    out = rows[starts].copy()
    out[:, 3] = reach[np.append(starts[1:], len(rows)) - 1]
    return out
