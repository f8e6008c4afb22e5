"""SimHash fingerprints, the Gray-order index and the components they give."""

import random

import numpy as np
import pytest
import xxhash
from conftest_llm import SMALL, frame, needs_tables, words

from spinledger.llm import gray_index, segments, simhash_dedup


def brute_code(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = lowered.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ")
    found = [word for word in found if word]
    runs = [found[k : k + 3] for k in range(len(found) - 2)] or ([found] if found else [])
    hashes = [xxhash.xxh64(" ".join(run).encode(), seed=42).intdigest() for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(codes):
    """{position: smallest id} for (id, code) rows, comparing every pair."""
    values = sorted({code for _, code in codes})
    root = {value: value for value in values}

    def end(value):
        while root[value] != value:
            value = root[value]
        return value

    array = np.array(values, np.uint64)
    for value in values:
        for other in array[np.bitwise_count(array ^ np.uint64(value)) <= 2].tolist():
            a, b = sorted((end(value), end(other)))
            root[b] = a
    least = {}
    for doc_id, code in codes:
        if doc_id is not None:
            least[end(code)] = min(doc_id, least.get(end(code), doc_id))
    return [least.get(end(code)) for _, code in codes]


def test_gray_rank_orders_neighbours():
    codes = np.array([k ^ (k >> 1) for k in range(300)], np.uint64)
    assert gray_index.gray_rank(codes).tolist() == list(range(300))


@pytest.mark.parametrize("count", [0, 1, 2, 5, 64, 1000])
def test_tree_finds_what_comparing_all_finds(count):
    rng = np.random.default_rng(count)
    centres = rng.integers(0, 1 << 63, max(1, count // 20), dtype=np.uint64)
    codes = centres[rng.integers(0, len(centres), count)] if count else np.empty(0, np.uint64)
    codes = np.unique(codes ^ (np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64)))
    codes = codes[np.argsort(gray_index.gray_rank(codes))]
    who, where = gray_index.search(gray_index.build_codes(codes), codes, 2)
    found = set(zip(who.tolist(), where.tolist(), strict=True))
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    assert found == set(zip(*(side.tolist() for side in np.nonzero(apart <= 2)), strict=True))


def test_representatives_of_chains():
    a, b = np.array([5, 4, 3, 9]), np.array([4, 3, 2, 8])
    assert gray_index.representatives(a, b, 10).tolist() == [0, 1, 2, 2, 2, 2, 6, 7, 8, 8]


def test_fingerprint_of_pieces(monkeypatch):
    rng = random.Random(1)
    for count in (0, 1, 2, 3, 4, 50, 700):
        text = "  ".join(words(rng, count)) + " \tÜbel"
        expected = brute_code(text)
        for limit in (1, 7, 64, 1 << 20):
            with monkeypatch.context() as patch:
                patch.setattr(simhash_dedup, "pieces", lambda data, limit=limit: segments.pieces(data, limit))
                assert simhash_dedup.fingerprint(text.encode().lower()) == expected


def near_rows(rng, groups=12, copies=25):
    rows = []
    for _ in range(groups):
        base = words(rng, 400)
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = "new" + str(rng.randrange(1000))
            rows.append(" ".join(own))
    return [(rng.randrange(10_000), text) for text in rows]


@pytest.mark.parametrize("block_rows,visitors", [(2048, 262_144), (8, 16)])
def test_components_equal_brute_force(spark, block_rows, visitors):
    rows = near_rows(random.Random(5))
    codes = [(doc_id, brute_code(text)) for doc_id, text in rows]
    expected = sorted(zip([row[0] for row in rows], [code for _, code in codes], brute_components(codes), strict=True))
    got = simhash_dedup.similar_fingerprints(frame(spark, rows).repartition(5), block_rows=block_rows, visitors=visitors).collect()
    assert sorted((row["doc_id"], row["fingerprint"] % 2**64, row["component_id"]) for row in got) == expected
    assert len({row["component_id"] for row in got}) < len({code for _, code in codes})


def test_awkward_rows(spark, awkward):
    got = simhash_dedup.similar_fingerprints(awkward).collect()
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    codes = [(doc_id, brute_code(text)) for doc_id, text in rows]
    expected = zip([row[0] for row in rows], [code for _, code in codes], brute_components(codes), strict=True)
    assert sorted(map(repr, expected)) == sorted(repr((row["doc_id"], row["fingerprint"] % 2**64, row["component_id"])) for row in got)
    assert {row["component_id"] for row in got if row["fingerprint"] == 0} == {2}
    assert simhash_dedup.similar_fingerprints(frame(spark, [])).count() == 0


def test_megabytes_in_one_text(spark):
    text = " ".join(words(random.Random(2), 400_000))
    got = simhash_dedup.similar_fingerprints(frame(spark, [(1, text), (2, text + " end")])).collect()
    assert {row["component_id"] for row in got} == {1} and got[0]["fingerprint"] % 2**64 == brute_code(text)


@needs_tables
def test_query_equals_brute_force(spark):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    codes = [(doc_id, brute_code(text)) for doc_id, text in rows]
    expected = sorted(zip([row[0] for row in rows], [f"{code:016x}" for _, code in codes], brute_components(codes), strict=True))
    got = simhash_dedup.op12_simhash(spark, SMALL)
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(row)[:3] for row in got.collect()) == expected
