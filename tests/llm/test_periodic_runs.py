"""Periodic runs: tiles, Z-functions and whole results against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest_llm import SMALL, frame, needs_tables, words

from spinledger.llm import periodic_runs, tiles

SPACES = " \t\n\v\f\r"


def split(text):
    for space in SPACES:
        text = (text or "").replace(space, " ")
    return [word for word in text.split(" ") if word]


def brute_runs(found):
    """Every (start, length, period), by comparing all words with all shifts."""
    n = len(found)
    ids = {}
    key = np.array([ids.setdefault(word, len(ids)) for word in found] + [-1])
    runs = {}
    for period in range(1, n // 4 + 1):
        same = np.concatenate(([False], key[: n - period] == key[period:n], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = end - start + period
            if length >= max(6, 4 * period):
                runs.setdefault((start, length), period)
    return sorted((start, length, period) for (start, length), period in runs.items())


def brute_collapsed(found, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(word for k, word in enumerate(found) if k not in gone)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def planted(doc_id, found):
    h, n = zlib.crc32(str(doc_id).encode()), len(found)
    if doc_id is None or h % 10 or not n:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [word if k < a else found[a + (k - a) % p] for k, word in enumerate(found)]


def brute_row(doc_id, text):
    found = planted(doc_id, split(text))
    runs = brute_runs(found)
    best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=None)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *shown, digest(lines), digest(brute_collapsed(found, runs)))


def repeating(rng, size):
    """Words with runs of many periods, some side by side, nested or broken."""
    found = []
    while len(found) < size:
        kind = rng.random()
        if kind < 0.4:
            found += words(rng, rng.randint(1, 20))
        elif kind < 0.9:
            part = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 7, 16, 33]))]
            found += (part * rng.randint(2, 9))[: rng.randint(1, 400)]
        else:
            part = ["x", "y"] * rng.randint(2, 6) + ["z"]
            found += part * rng.randint(3, 6)
    return found[:size]


def test_z_values():
    rng = random.Random(1)
    for _ in range(50):
        text = [rng.randint(0, 1) for _ in range(rng.randint(1, 40))]
        expected = [next((j for j in range(len(text) - k) if text[j] != text[k + j]), len(text) - k) for k in range(len(text))]
        assert tiles.z_values(text) == expected


def test_capitals_make_other_words():
    data = np.frombuffer(b"The the THE the tHe a A The", np.uint8)
    _, keys = tiles.word_keys(data, np.array([0, len(data)]), 1 << 20)
    same = [[a == b for b in keys] for a in keys]
    found = data.tobytes().split()
    assert same == [[a == b for b in found] for a in found]
    _, pieced = tiles.word_keys(data, np.array([0, len(data)]), 5)
    assert (pieced == keys).all()


def test_fragments_are_joined():
    rows = np.array([(1, 2, 0, 4), (1, 2, 4, 6), (1, 2, 7, 9), (1, 3, 0, 9), (0, 2, 5, 6), (1, 2, 1, 2)])
    assert tiles.joined(rows).tolist() == [[0, 2, 5, 6], [1, 2, 0, 6], [1, 2, 7, 9], [1, 3, 0, 9]]
    assert len(tiles.joined(np.empty((0, 4), np.int64))) == 0


@pytest.mark.parametrize("long_chars", [0, 700, 1 << 22])
def test_runs_equal_brute_force(spark, long_chars):
    rng = random.Random(8)
    texts = [" ".join(repeating(rng, rng.randint(0, 700))) for _ in range(120)] + ["a " * 6, "a " * 5, "ab ba " * 4, "ab ba " * 3 + "ab", "A a " * 9]
    got = periodic_runs.periodic_runs(frame(spark, list(enumerate(texts))).repartition(3), long_chars).collect()
    for row in got:
        found = split(texts[row["doc_id"]])
        runs = brute_runs(found)
        assert [tuple(run) for run in row["runs"]] == runs
        assert row["collapsed_sha256"] == digest(brute_collapsed(found, runs))
    assert len(got) == len(texts) and sum(len(row["runs"]) for row in got) > 300


def test_pieces_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    found = repeating(rng, 3000)
    runs = brute_runs(found)
    gone = [(start + period, start + length) for start, length, period in runs]
    merged = tiles.joined(np.array([(0, 0, a, b) for a, b in gone]).reshape(-1, 4))
    monkeypatch.setattr(periodic_runs, "pieces", lambda text: __import__("spinledger.llm.segments", fromlist=["pieces"]).pieces(text, 50))
    text = " \n".join(found).encode()
    assert periodic_runs._digest(text, [(int(a), int(b)) for _, _, a, b in merged]) == digest(brute_collapsed(found, runs))


def test_awkward_rows(spark, awkward):
    got = periodic_runs.periodic_runs(awkward).collect()
    assert len(got) == 10 and all(row["runs"] == [] for row in got)
    expected = sorted(digest(" ".join(split(row["text"]))) for row in awkward.collect())
    assert sorted(row["collapsed_sha256"] for row in got) == expected
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0
    kept = periodic_runs.with_planted_repeats(awkward).collect()
    assert sorted((repr(row["doc_id"]), " ".join(planted(row["doc_id"], split(row["text"])))) for row in awkward.collect()) == sorted((repr(row["doc_id"]), " ".join(split(row["text"]))) for row in kept)


def test_one_text_of_a_million_words(spark):
    part = words(random.Random(6), 70_001)
    text = " ".join(["begin", *part * 14, "end", *["so"] * 20_000])
    row = periodic_runs.periodic_runs(frame(spark, [(1, text)]), 1000).first()
    assert [tuple(run) for run in row["runs"]][-1] == (14 * 70_001 + 2, 20_000, 1)
    assert (1, 14 * 70_001, 70_001) in [tuple(run) for run in row["runs"]]


@needs_tables
def test_query_equals_sql_and_brute_force(spark):
    from compare import compare, duck

    result = periodic_runs.op11_periodic_runs(spark, SMALL)
    ours, theirs = compare(result, duck(SMALL), periodic_runs.SQL)
    assert ours == theirs
    expected = [brute_row(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, result.collect())) == sorted(expected)
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
