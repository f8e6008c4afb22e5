"""A cuckoo filter: approximate membership that also forgets."""

from __future__ import annotations

import numpy as np

from .words import mix

SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key has two buckets it may lie in.

    Keys are 64-bit hashes. ``insert`` is false when the filter is too full; the caller
    then builds a larger one from its exact table. Only keys that were inserted may be
    deleted.
    """

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.mask = len(cells) - 1

    @classmethod
    def for_keys(cls, count: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(count, 1) / (SLOTS * 0.8) + 1))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def build(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter that holds all keys."""
        count = len(keys)
        while True:
            built = cls.for_keys(count)
            if all(built.insert(key) for key in keys.tolist()):
                return built
            count = 2 * count + SLOTS

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mixed = mix(keys.astype(np.uint64))
        prints = (mixed >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = (mixed & np.uint64(self.mask)).astype(np.int64)
        return prints, one, self._other(one, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(np.uint64)).astype(np.int64) & self.mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(keys)
        return ((self.cells[one] == prints[:, None]) | (self.cells[two] == prints[:, None])).any(axis=1)

    def insert(self, key: int) -> bool:
        prints, one, two = self._places(np.array([key], np.uint64))
        fingerprint, buckets = prints[0], (int(one[0]), int(two[0]))
        for bucket in buckets:
            if self._put(bucket, fingerprint):
                return True
        bucket = buckets[key & 1]
        for kick in range(MAX_KICKS):
            slot = (key + kick) % SLOTS
            fingerprint, self.cells[bucket, slot] = self.cells[bucket, slot].copy(), fingerprint
            bucket = int(self._other(np.array([bucket]), np.array([fingerprint], np.uint16))[0])
            if self._put(bucket, fingerprint):
                return True
        return False

    def _put(self, bucket: int, fingerprint: np.uint16) -> bool:
        free = np.flatnonzero(self.cells[bucket] == 0)
        if len(free):
            self.cells[bucket, free[0]] = fingerprint
        return bool(len(free))

    def delete(self, key: int) -> None:
        prints, one, two = self._places(np.array([key], np.uint64))
        for bucket in (int(one[0]), int(two[0])):
            held = np.flatnonzero(self.cells[bucket] == prints[0])
            if len(held):
                self.cells[bucket, held[0]] = 0
                return
        raise KeyError(key)
