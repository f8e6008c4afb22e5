"""Spelling variants: counting, the trees, and groups against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SMALL, frame, needs_tables, words

from spinledger.llm import count_tree, spelling_variants



def brute_counts(rows, misspelt=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            mark = zlib.crc32(f"{doc_id}:{run}".encode())
            if misspelt and doc_id is not None and mark % misspelt == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    return counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_groups(counts, times=5):
    near = {word: [other for other in counts if one_edit(word, other)] for word in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        forms[word] = best if best is not None and counts[best] >= times * counts[word] else None
    rows = []
    for word in counts:
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.append((word, forms[word], root, counts[word], len(near[word]), counts[forms[word]] if forms[word] is not None else None))
    return sorted(rows)


def some_words(rng, count):
    found = set()
    while len(found) < count:
        base = "".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 8)))
        found |= {base, base[1:] + "a", base[:2] + rng.choice("xyzÿ") + base[3:], base[:3] + base[4:]}
    return {word: rng.choice([5, 6, 30, 31, 160, 900]) for word in sorted(found)}


@pytest.mark.parametrize("sizes", [{}, {"sample_words": 50, "leaf_words": 20, "block_words": 7, "searchers": 11}])
def test_groups_equal_brute_force(spark, sizes):
    counts = some_words(random.Random(len(sizes)), 700)
    got = spelling_variants.spelling_groups(frame(spark, list(counts.items()), "word string, n bigint").repartition(3), **sizes)
    assert sorted(map(tuple, got.collect())) == brute_groups(counts)


def test_anagrams_share_a_leaf_and_are_still_dealt(spark):
    rng = random.Random(9)
    letters = list("aabbccdd")
    counts = {"".join(rng.sample(letters, 8)): rng.choice([5, 50]) for _ in range(400)} | {"aabbccda": 5, "aabbccd": 300}
    got = spelling_variants.spelling_groups(frame(spark, list(counts.items()), "word string, n bigint"), leaf_words=10, block_words=16, searchers=32)
    assert sorted(map(tuple, got.collect())) == brute_groups(counts)


def test_boxes_lose_no_pair():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 3, (800, 12)).astype(np.int16)
    tree, leaves = count_tree.partition(points, 25)
    homes = count_tree.home_leaves(tree, points)
    assert set(homes.tolist()) <= set(range(leaves)) and leaves > 10
    for radius in (1, 2):
        who, leaf = count_tree.leaves_within(tree, points, radius)
        reached = set(zip(who.tolist(), leaf.tolist(), strict=True))
        apart = np.abs(points[:, None].astype(int) - points[None]).sum(axis=2)
        assert all((i, int(homes[j])) in reached for i, j in zip(*np.nonzero(apart <= radius), strict=True))
        assert len(reached) < 800 * leaves
        one, two = count_tree.pairs_within(points, points, radius)
        assert sorted(zip(one.tolist(), two.tolist(), strict=True)) == sorted(zip(*(side.tolist() for side in np.nonzero(apart == radius)), strict=True))


def test_edits():
    def apart(a, b):
        return bool(count_tree.one_edit_apart(count_tree.code_points([a], len(a)), count_tree.code_points([b], len(b)))[0])

    assert apart("abcdef", "abxdef") and not apart("abcdef", "abcdef") and not apart("abcdef", "badcef")
    assert apart("aabcde", "aaabcde") and apart("abcdef", "abcdefg") and apart("bcdefg", "abcdefg") and not apart("abcdef", "gabcdfe")


def test_counts_of_awkward_texts(spark, awkward, monkeypatch):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    expected = brute_counts(rows, 3)
    got = {row["word"]: row["n"] for row in spelling_variants.word_counts(awkward, 3).collect()}
    assert got == dict(expected)
    assert spelling_variants.word_counts(frame(spark, [])).count() == 0
    assert spelling_variants.spelling_groups(frame(spark, [], "word string, n bigint")).count() == 0


def test_a_million_words_in_one_text(spark):
    rng = random.Random(4)
    text = " ".join(f"{a}{b}" for a, b in zip(words(rng, 300_000), words(rng, 300_000), strict=True)) + " ÀÖ×÷ÿ Ā" + "z" * 100_000
    got = {row["word"]: row["n"] for row in spelling_variants.word_counts(frame(spark, [(1, text)]), 199).collect()}
    assert got == dict(brute_counts([(1, text)], 199))


@needs_tables
def test_query_equals_sql_and_brute_force(spark):
    from compare import compare, duck

    result = spelling_variants.op13_spelling_variants(spark, SMALL)
    ours, theirs = compare(result, duck(SMALL), spelling_variants.SQL)
    assert ours == theirs
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    counts = {word: n for word, n in brute_counts(rows, 199).items() if len(word) >= 6 and n >= 5}
    assert sorted(map(tuple, result.collect())) == brute_groups(counts)
