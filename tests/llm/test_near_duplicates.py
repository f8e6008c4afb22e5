"""Near duplicates against all pairs of sets."""

import random
import re

import numpy as np
import pytest

from compare import compare, duck
from conftest_llm import SMALL, frame, needs_tables, words
from spinledger.llm.components import merged
from spinledger.llm.minhash_dedup import SQL, _linked_pairs, deduplicated, near_duplicates, op1_near_duplicates
from spinledger.llm.setsketch import Shape


def brute(rows, size=2):
    sets = {}
    for doc_id, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        own = [re.sub("[A-Z]", lambda m: m[0].lower(), word) for word in own]
        runs = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} or ({tuple(own)} if own else set())
        sets[doc_id] = runs
    component = {doc_id: doc_id for doc_id in sets}

    def root(node):
        while component[node] != node:
            node = component[node]
        return node

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                one, two = root(a), root(b)
                component[max(one, two)] = min(one, two)
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in ids}


def edited(rng, text, changes):
    text = list(text)
    for _ in range(changes):
        text[rng.randrange(len(text))] = words(rng, 1)[0] + "q"
    return text


@pytest.fixture(scope="module")
def family_rows():
    """Copies, chains of edits that end beyond the limit, short texts, unrelated texts."""
    rng = random.Random(8)
    base = words(rng, 120)
    texts = [base] * 5 + [edited(rng, base, rng.randint(0, 14)) for _ in range(60)]
    chain = words(rng, 60)
    for _ in range(12):
        texts.append(chain)
        chain = edited(rng, chain, 2)
    texts += [words(rng, rng.randint(1, 80)) for _ in range(80)]
    texts += [["a"], ["A"], ["a", "b"], ["b"], []]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(doc_id, " ".join(texts[k])) for doc_id, k in enumerate(order)]


def test_equals_all_pairs(spark, family_rows):
    expected = brute(family_rows)
    got = near_duplicates(frame(spark, family_rows)).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in got} == expected
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in got)


def test_blocks_smaller_than_a_family(spark, family_rows, monkeypatch):
    monkeypatch.setattr("spinledger.llm.minhash_dedup.CHUNK", 7)
    got = near_duplicates(frame(spark, family_rows)).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in got} == brute(family_rows)


def test_near_copies_among_texts_of_common_passages(spark):
    """The smallest class of every bucket that two copies share can be an unrelated text."""
    rng = random.Random(21)
    passages = [[f"p{n}w{k}" for k in range(6)] for n in range(150)]
    texts = [sum((passages[n] for n in sorted(rng.sample(range(150), 69))), []) for _ in range(600)]
    texts += [[*text[:-30], *(f"t{n}e{k}" for k in range(30))] for n, text in enumerate(texts)]
    rows = [(doc_id, " ".join(text)) for doc_id, text in enumerate(texts)]
    # Bands of three registers fill the buckets of a small table as six do those of a large one.
    got = {row["doc_id"]: row["component_id"] for row in near_duplicates(frame(spark, rows), shape=Shape(bands=20, rows=3)).collect()}
    # The copies overlap by 86 %, all other pairs by about 30 %.
    assert got == {doc_id: doc_id - 600 if doc_id >= 600 else doc_id for doc_id in range(1200)}


def test_linked_pairs_count_exactly(monkeypatch):
    monkeypatch.setattr("spinledger.llm.minhash_dedup.COLUMNS", 3)
    sets = [np.array(own, np.uint64).tobytes() for own in ([1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 9, 10], [])]
    left, right = _linked_pairs(sets, sets, 80)
    assert {(i, j) for i, j in zip(left.tolist(), right.tolist(), strict=True) if i < j} == {(0, 1)}


def test_awkward_rows(spark, awkward):
    got = sorted(map(tuple, near_duplicates(awkward).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert len(got) == 10
    assert got.count((1, 5, 1, True)) == 3  # two copies and another text of five shingles
    assert (2, 0, 2, True) in got and (3, 0, 3, True) in got and (4, 0, 4, True) in got
    assert (None, 5, None, True) in got and (None, 0, None, True) in got


def test_deduplicated_keeps_one_of_each_group_and_all_columns(spark, awkward):
    got = deduplicated(awkward, 5)
    assert got.columns == awkward.columns
    assert sorted((row["doc_id"] or 0) for row in got.collect()) == [0, 0, 1, 1, 2, 3, 4, 5, 6]


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert deduplicated(frame(spark, []), 5).count() == 0


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    labels = merged(None, frame(spark, edges, "a bigint, b bigint"))
    labels = merged(labels, frame(spark, [(120, 30), (300, 301)], "a bigint, b bigint"))
    got = {row["node"]: row["component"] for row in labels.collect()}
    expected = {k: 0 for k in [*range(1, 41), *range(100, 140)]} | {200 + k: 200 for k in range(1, 9)} | {301: 300}
    assert got == expected


@needs_tables
def test_query_equals_all_pairs(spark):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op1_near_duplicates(spark, SMALL).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in got} == brute(rows)


@needs_tables
def test_query_equals_sql(spark):
    ours, theirs = compare(op1_near_duplicates(spark, SMALL), duck(SMALL), SQL)
    assert ours[0] == theirs[0] and ours[1] == theirs[1]
