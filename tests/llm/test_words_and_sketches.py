"""Word finding on bytes, sketches, the cuckoo filter and the loser tree."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spinledger.llm import words as w
from spinledger.llm.cuckoo import CuckooFilter
from spinledger.llm.loser_tree import merge_runs
from spinledger.llm.setsketch import Shape, band_keys, can_reach, sketches

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATTERNS = {w.SPACES: r"[^\x20\x09-\x0D]+", w.NOT_ALPHANUMERIC: r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def found(texts, delimiters, limit=64):
    out = [[] for _ in texts]
    for first, data, offsets in w.text_chunks(pa.array(texts, pa.string()), limit):
        got = w.words_of(data, offsets, delimiters)
        for doc, start, end, key in zip(*got, strict=True):
            out[first + doc].append((w.lower_ascii(data[start:end]).tobytes().decode(), int(key)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZé 9._\n\t\x0b\x00İſ中", max_size=40)), max_size=8), st.sampled_from(sorted(PATTERNS)))
def test_words_equal_the_pattern(texts, delimiters):
    got = found(texts, delimiters)
    expected = [re.findall(PATTERNS[delimiters], (text or "").translate(CAPITALS)) for text in texts]
    assert [[word for word, _ in own] for own in got] == expected
    by_word = {}
    for own in got:
        for word, key in own:
            assert by_word.setdefault(word, key) == key
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_of_short_and_long_texts():
    chunks = list(w.text_chunks(pa.array(["a b c", "a", None, "b c", "a b"])))
    (_, data, offsets), = chunks
    doc, keys = w.shingle_keys(w.words_of(data, offsets, w.SPACES), 2)
    assert doc.tolist() == [0, 0, 1, 3, 4]
    assert keys[1] == keys[3] and keys[0] == keys[4] and len(set(keys.tolist())) == 3


@pytest.mark.parametrize("similarity", [0.2, 0.6, 0.9])
def test_registers_agree_as_often_as_sets_overlap(similarity):
    rng = np.random.default_rng(1)
    shape = Shape(base=1.001)
    shared = int(2000 * similarity)
    own = 2000 - shared
    pool = rng.integers(0, 2**63, 2000 + own, dtype=np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(np.concatenate((pool[:shared], pool[2000:])))
    registers = sketches(np.concatenate((a, b)), np.array([2000, 2000]), shape)
    true = shared / (2000 + own)
    assert abs((registers[0] == registers[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / shape.registers) + 0.01


def test_registers_merge_by_maximum():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    parts = [pool[:500], pool[300:]]
    apart = sketches(np.concatenate(parts), np.array([len(p) for p in parts]), Shape())
    whole = sketches(pool, np.array([len(pool)]), Shape())
    assert (np.maximum(apart[0], apart[1]) == whole[0]).all()


def test_likelihood_keeps_similar_and_drops_other_pairs():
    rng = np.random.default_rng(4)
    shape = Shape()
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [np.sort(pool[:1000]), np.sort(pool[60:1060]), np.sort(pool[800:1800]), np.sort(pool[:300])]
    registers = sketches(np.concatenate(sets), np.array([len(s) for s in sets]), shape)
    sizes = np.array([len(s) for s in sets])
    left, right = np.array([0, 0, 0]), np.array([1, 2, 3])
    assert can_reach(registers[left], registers[right], sizes[left], sizes[right], 0.8, shape.base).tolist() == [True, False, False]
    assert band_keys(registers, shape).shape == (4, shape.bands)


def test_sketch_of_one_element_and_of_none():
    registers = sketches(np.array([5], np.uint64), np.array([0, 1]), Shape())
    assert (registers[0] == registers[0, 0]).all() and len(set(registers[1].tolist())) > 50


def test_cuckoo_filter_inserts_deletes_and_grows():
    keys = np.random.default_rng(5).integers(0, 2**63, 3000, dtype=np.uint64)
    built = CuckooFilter.build(keys)
    assert built.contains(keys).all()
    others = np.random.default_rng(6).integers(0, 2**63, 20000, dtype=np.uint64)
    assert built.contains(others).mean() < 0.002
    for key in keys[:1000].tolist():
        built.delete(key)
    again = CuckooFilter.from_bytes(built.to_bytes())
    assert again.contains(keys[1000:]).all() and again.contains(keys[:1000]).mean() < 0.01
    with pytest.raises(KeyError):
        CuckooFilter.for_keys(1).delete(7)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree_merges_stably(runs):
    tagged = [[(value, number, k) for k, value in enumerate(sorted(run))] for number, run in enumerate(runs)]
    assert list(merge_runs([iter(run) for run in tagged])) == sorted(item for run in tagged for item in run)
