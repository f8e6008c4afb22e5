"""Search of bit strings by Hamming distance in a tree over their Gray order.

Neighbours in Gray order share most of their bits. A node of the tree holds the bits that
all strings below it have in common and that no node above it holds already, as a mask and a
pattern. A search adds up the differences to the patterns on its way down and leaves a whole
group as soon as the sum exceeds the radius.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Children of a node, and (query, node) pairs that are looked at together.
ARITY = 4
FRONTIER = 1 << 17
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Level(NamedTuple):
    """Nodes of one height: the bits each holds apart from those of the nodes above."""

    mask: np.ndarray
    pattern: np.ndarray


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each 64-bit code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def build(mask: np.ndarray, pattern: np.ndarray, arity: int = ARITY) -> list[Level]:
    """Levels from the items, which lie in Gray order, up to a single root.

    An item is a code (``mask`` of all bits) or the common bits of a block of codes.
    """
    shared = [(mask, pattern & mask)]
    while len(shared[-1][0]) > 1:
        below_mask, below = shared[-1]
        starts = np.arange(0, len(below), arity)
        same = ~(np.bitwise_or.reduceat(below, starts) ^ np.bitwise_and.reduceat(below, starts))
        common = np.bitwise_and.reduceat(below_mask, starts) & same
        shared.append((common, below[starts] & common))
    levels = []
    for height, (own, bits) in enumerate(shared):
        above = np.zeros(1, np.uint64)
        if height + 1 < len(shared):
            above = shared[height + 1][0][np.arange(len(own)) // arity]
        levels.append(Level(own & ~above, bits))
    return levels


def build_codes(codes: np.ndarray) -> list[Level]:
    return build(np.full(len(codes), _ALL), codes)


def search(levels: list[Level], queries: np.ndarray, radius: int, arity: int = ARITY) -> tuple[np.ndarray, np.ndarray]:
    """(query, item) positions of all items within ``radius`` of each query."""
    none = np.empty(0, np.int64)
    if not len(levels[0].mask) or not len(queries):
        return none, none
    found = []
    size = max(1, FRONTIER // max(1, 4 * arity))
    for first in range(0, len(queries), size):
        part = queries[first : first + size]
        at = np.arange(len(part))
        node = np.zeros(len(part), np.int64)
        spent = np.zeros(len(part), np.uint8)
        for height in range(len(levels) - 1, -1, -1):
            if height < len(levels) - 1:
                at, spent = np.repeat(at, arity), np.repeat(spent, arity)
                node = (node[:, None] * arity + np.arange(arity)).reshape(-1)
                real = node < len(levels[height].mask)
                at, node, spent = at[real], node[real], spent[real]
            mask, pattern = levels[height]
            spent = spent + np.bitwise_count((part[at] ^ pattern[node]) & mask[node])
            near = spent <= radius
            at, node, spent = at[near], node[near], spent[near]
        found.append((at + first, node))
    return np.concatenate([one for one, _ in found]), np.concatenate([two for _, two in found])


def representatives(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The smallest node reachable from each of ``count`` nodes over links (a, b)."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        while not np.array_equal(after, after[after]):
            after = after[after]
        if np.array_equal(after, label):
            return label
        label = after
