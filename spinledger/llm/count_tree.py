"""K-d trees over the letter counts of words, searched by L1 distance.

A word's vector counts its letters. Replacing a letter moves it by an L1 distance of two,
inserting or deleting one by a distance of one, so a search with a small radius meets every
word one edit away. A subtree is left out as soon as its box lies beyond the radius.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Points of a leaf of a tree that is searched in memory.
LEAF_POINTS = 32


class Split(NamedTuple):
    """Counts of ``letter`` up to ``at`` go left, larger ones right; a leaf has a number instead."""

    letter: int
    at: int
    left: object
    right: object


def letter_counts(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """(words x letters) of words given as rows of code points; every one must be in ``alphabet``."""
    counts = np.zeros((len(codes), len(alphabet)), np.int16)
    for column in range(codes.shape[1]):
        np.add.at(counts, (np.arange(len(codes)), np.searchsorted(alphabet, codes[:, column])), 1)
    return counts


def code_points(words: list[str], length: int) -> np.ndarray:
    """(words x length) of words that all have ``length`` letters."""
    if not words:
        return np.empty((0, length), np.uint32)
    return np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length)


def partition(vectors: np.ndarray, leaf_points: int, first: int = 0):
    """(tree, number of leaves): splits at medians of the widest spread letter.

    Points of equal vectors stay together, so a leaf of only such points can be larger.
    """
    if len(vectors) > leaf_points:
        spread = vectors.var(axis=0)
        for letter in np.argsort(-spread, kind="stable").tolist():
            own = vectors[:, letter]
            low, high = int(own.min()), int(own.max())
            if low == high:
                break
            at = min(int(np.median(own)), high - 1)
            left = own <= at
            one, between = partition(vectors[left], leaf_points, first)
            two, end = partition(vectors[~left], leaf_points, first + between)
            return Split(letter, at, one, two), between + end
    return first, 1


def home_leaves(tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf each vector lies in."""
    leaves = np.empty(len(vectors), np.int64)

    def go(node, at: np.ndarray) -> None:
        if not isinstance(node, Split):
            leaves[at] = node
            return
        left = vectors[at, node.letter] <= node.at
        go(node.left, at[left])
        go(node.right, at[~left])

    go(tree, np.arange(len(vectors)))
    return leaves


def leaves_within(tree, vectors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, leaf) for every leaf whose box lies within ``radius`` of a vector."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    top = int(vectors.max(initial=0)) + radius + 1

    def go(node, at: np.ndarray, spent: np.ndarray, box: dict[int, tuple[int, int]]) -> None:
        if not len(at):
            return
        if not isinstance(node, Split):
            found.append((at, np.full(len(at), node)))
            return
        own = vectors[at, node.letter].astype(np.int64)
        low, high = box.get(node.letter, (0, top))
        before = np.maximum(low - own, 0) + np.maximum(own - high, 0)
        for child, sides in ((node.left, (low, min(high, node.at))), (node.right, (max(low, node.at + 1), high))):
            # Only the distance along the split letter changes from a box to its halves.
            now = spent - before + np.maximum(sides[0] - own, 0) + np.maximum(own - sides[1], 0)
            near = now <= radius
            go(child, at[near], now[near], box | {node.letter: sides})

    go(tree, np.arange(len(vectors)), np.zeros(len(vectors), np.int64), {})
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([one for one, _ in found]), np.concatenate([two for _, two in found])


def pairs_within(points: np.ndarray, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) positions at an L1 distance of exactly ``distance``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # One edit changes the parity of at most two letters: 64 parities in a word tell most others apart.
    parity = [_parities(points), _parities(queries)]

    def go(own: np.ndarray, at: np.ndarray) -> None:
        if not len(at) or not len(own):
            return
        low, high = points[own].min(axis=0), points[own].max(axis=0)
        wide = np.flatnonzero(low != high)
        here = queries[at]
        apart = (np.maximum(low - here, 0) + np.maximum(here - high, 0)).sum(axis=1)
        at = at[apart <= distance]
        if len(own) <= LEAF_POINTS or not len(wide):
            for first in range(0, len(own), 4096):
                block = own[first : first + 4096]
                for begin in range(0, len(at), 1024):
                    some = at[begin : begin + 1024]
                    one, two = np.nonzero(np.bitwise_count(parity[1][some][:, None] ^ parity[0][block][None, :]) <= distance)
                    one, two = some[one], block[two]
                    exact = np.abs(queries[one] - points[two]).sum(axis=1) == distance
                    found.append((one[exact], two[exact]))
            return
        letter = int(wide[np.argmax(points[own][:, wide].var(axis=0))])
        values = points[own, letter]
        left = values <= min(int(np.median(values)), int(values.max()) - 1)
        go(own[left], at)
        go(own[~left], at)

    go(np.arange(len(points)), np.arange(len(queries)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([one for one, _ in found]), np.concatenate([two for _, two in found])


def _parities(vectors: np.ndarray) -> np.ndarray:
    bits = np.uint64(1) << (np.arange(vectors.shape[1]) % 64).astype(np.uint64)
    return np.bitwise_xor.reduce(np.where(vectors & 1, bits, np.uint64(0)), axis=1) if vectors.shape[1] else np.zeros(len(vectors), np.uint64)


def one_edit_apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one replaced letter, or by one more in ``long``."""
    length = short.shape[1]
    if long.shape[1] == length:
        return (short != long).sum(axis=1) == 1
    before = np.cumprod(short == long[:, :length], axis=1).sum(axis=1)
    after = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= length
