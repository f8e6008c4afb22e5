"""Words of whole texts, found and hashed on Arrow buffers with numpy.

Texts are handled as UTF-8 bytes. Every delimiter these operators use is an ASCII byte,
so a byte above 0x7F is always part of a word and no text has to become a Python string.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# The two word classes, as the bytes that do NOT belong to a word. They are
# meant for lower-cased text; capital letters count as the small ones they become.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALPHANUMERIC = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

# Texts are worked through in pieces of about so many bytes, whatever the batch holds.
CHUNK_BYTES = 1 << 19
# Odd 64-bit constants of the polynomial and of the mixing steps below.
_BASE = 0x9E3779B97F4A7C15
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


class Words(NamedTuple):
    """Words of several texts in order."""

    doc: np.ndarray  # index of the text
    start: np.ndarray  # first byte in the chunk
    end: np.ndarray  # byte after the last
    key: np.ndarray  # 64-bit hash of the lower-cased word


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = values ^ (values >> np.uint64(30))
    x = x * _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _lower_table()[data]


@lru_cache(maxsize=1)
def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A random 64-bit value for each byte; capital letters share that of the small ones."""
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return values[_lower_table()]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the power of 0, 1, 2... and the inverses, both modulo 2**64."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers))
    return both[0], both[1]


@lru_cache(maxsize=4)
def _is_word(delimiters: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(delimiters)] = False
    return table


def text_chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets) for runs of texts of about ``limit`` bytes.

    A null is an empty text. A text is never cut: one that is longer is a run of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, delimiters: bytes) -> Words:
    """The words of the texts that lie one after another in ``data``."""
    size = len(data)
    if not size:
        nothing = np.empty(0, np.int64)
        return Words(nothing, nothing, nothing, np.empty(0, np.uint64))
    inside = _is_word(delimiters)[data]
    text_starts = np.zeros(size + 1, dtype=bool)
    text_starts[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | text_starts[1:size]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | text_starts[1:size]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    # Sums of byte value times power: the difference of two is the hash of what lies between.
    powers, inverses = _powers(1 << max(CHUNK_BYTES.bit_length(), size.bit_length()))
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_byte_values()[data] * powers[:size], out=sums[1:])
    key = mix((sums[end] - sums[start]) * inverses[start])
    return Words(np.searchsorted(offsets, start, side="right") - 1, start, end, key)


def shingle_keys(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words, in order.

    A text with fewer words, but not none, counts as one run of all its words.
    """
    count = len(words.key)
    if not count:
        return words.doc, words.key
    doc = words.doc
    full = np.zeros(0, np.int64)
    keys = np.zeros(0, np.uint64)
    if count >= size:
        full = np.flatnonzero(doc[: count - size + 1] == doc[size - 1 :])
        keys = _run_key(words.key, full, size)
    docs, first, lengths = np.unique(doc, return_index=True, return_counts=True)
    short_docs, short_keys = [], []
    for length in range(1, size):
        at = lengths == length
        if at.any():
            short_docs.append(docs[at])
            short_keys.append(_run_key(words.key, first[at], length))
    all_docs = np.concatenate([doc[full], *short_docs])
    all_keys = np.concatenate([keys, *short_keys])
    if short_docs:
        order = np.argsort(all_docs, kind="stable")
        return all_docs[order], all_keys[order]
    return all_docs, all_keys


def _run_key(keys: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    run = np.full(len(at), length, np.uint64)
    for k in range(length):
        run = mix(run + keys[at + k])
    return run


def distinct_by_text(doc: np.ndarray, keys: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys text after text, offsets); ``doc`` must not decrease."""
    bounds = np.searchsorted(doc, np.arange(texts + 1))
    parts = [np.empty(0, np.uint64)]
    offsets = np.zeros(texts + 1, np.int64)
    for k in range(texts):
        own = np.sort(keys[bounds[k] : bounds[k + 1]])
        if len(own) > 1:
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        offsets[k + 1] = offsets[k] + len(own)
        parts.append(own)
    return np.concatenate(parts), offsets


def binary_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of a flat array as one binary value each; ``counts`` are elements per row."""
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.dtype.itemsize, out=ends[1:])
    flat = np.ascontiguousarray(values)
    rows = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    return rows.cast(pa.binary())
