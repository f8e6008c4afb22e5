"""Near-duplicate documents by SimHash fingerprints in a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import labelled, merged
from .gray_index import build, build_codes, representatives, search
from .gray_index import gray_rank as rank_of
from .segments import pieces
from .tables import document_rows, prepare, stored, table

# Fixed values of the contract: words of a shingle, seed of the hash, bits that may differ.
SHINGLE_WORDS, SEED, RADIUS = 3, 42, 2
# Fingerprints of a block at least; blocks grow beyond so that there are at most MAX_BLOCKS,
# whose common bits (24 bytes each) every task gets.
BLOCK_ROWS, MAX_BLOCKS = 2048, 65_536
# Visiting fingerprints that one task compares with a block at a time.
VISITORS = 262_144


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text that is in lower case already; zero without words."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        words = tail + piece.split()
        if len(words) < shingle_words:
            tail = words
            continue
        hashes = _hashes(words, shingle_words)
        ones += _ones(hashes)
        total += len(hashes)
        tail = words[len(words) - shingle_words + 1 :]
    if not total:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.array([digest(joined[start:end], SEED) for start, end in spans], "<u8")


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set."""
    sums = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 14):
        part = hashes[first : first + (1 << 14)]
        sums += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sums


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in the reflected Gray order, as a signed number that sorts alike."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(2**63)).cast("bigint"))


def similar_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, block_rows: int = BLOCK_ROWS, visitors: int = VISITORS) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) for every row of ``docs``.

    A bit of a document's fingerprint is set if more than half of the hashes of its word
    runs have it, repeats included; with fewer than ``shingle_words`` words the whole
    sequence is the one run. Documents whose fingerprints differ in at most ``radius`` bits
    are linked; ``component_id`` is the smallest doc_id reachable over links and ``kept``
    marks the document of that id. ``fingerprint`` is the code as a signed number.

    How: equal fingerprints are one row. The distinct ones are sorted by Gray rank and cut
    into blocks of bounded size; the bits that a block's codes share form a directory, again
    as a tree in Gray order. Every code searches the directory and visits its own block and
    the later ones whose shared bits leave room within the radius, there it searches the
    block's own tree. A block gives back one link per code that was reached, not its pairs.
    Blocks with many visitors compare them in several tasks. Nothing is capped.

    A null or empty text, or one without words, has fingerprint zero and is linked like any
    other. Words are found in pieces, so a very long text needs little more memory than its own size.
    A row without doc_id gets the component of its fingerprint, null if no linked row
    has a doc_id, and is kept. Rows that repeat a doc_id are judged each by its own text.
    Other columns are ignored. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    coded = stored(document_rows(docs).mapInArrow(_coded_rows(shingle_words), "doc_id bigint, fingerprint bigint"), "fingerprints")
    codes = stored(coded.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    labels = merged(None, _links(codes.select("fingerprint"), radius, block_rows, visitors))
    of_code = labelled(codes.withColumnRenamed("fingerprint", "node"), labels, "node", "component")
    smallest = of_code.groupBy("component").agg(F.min("first_id").alias("component_id"))
    components = of_code.join(smallest, "component").select(F.col("node").alias("fingerprint"), "component_id")
    return coded.join(components, "fingerprint").select(
        "doc_id", "fingerprint", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def _coded_rows(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            # Only A-Z change: bytes beyond ASCII are left alone.
            codes = np.array([fingerprint(text.as_py().lower(), shingle_words) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes.view(np.int64))], ["doc_id", "fingerprint"])

    return run


def _links(codes: DataFrame, radius: int, block_rows: int, visitors: int) -> DataFrame:
    """Links (a, b) of codes, at most one for each code and block it visits."""
    spark = codes.sparkSession
    size = max(block_rows, -(-codes.count() // MAX_BLOCKS))
    ranked = codes.withColumn("rank", gray_rank(F.col("fingerprint"))).orderBy("rank")
    blocks = stored(ranked.select("fingerprint").mapInArrow(_block_rows(size), "fingerprint bigint, block bigint"), "gray-blocks")
    summary = blocks.groupBy("block").agg(F.bit_and("fingerprint").alias("ands"), F.bit_or("fingerprint").alias("ors")).orderBy("block").toPandas()
    ands, ors = (summary[name].to_numpy(np.int64).view(np.uint64) for name in ("ands", "ors"))
    sent = spark.sparkContext.broadcast((summary["block"].to_numpy(np.int64), build(~(ands ^ ors), ands)))
    visits = stored(blocks.mapInArrow(_visit_rows(sent, radius), "fingerprint bigint, block bigint, home boolean"), "visits")
    parts = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(visitors)).cast("int").alias("parts"))
    dealt = visits.join(parts, "block")
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    # The codes of a block take part in all of its parts, each visitor in one.
    members = dealt.where("home").select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "fingerprint", F.lit(True).alias("home"))
    guests = dealt.select("block", part.alias("part"), "fingerprint", F.lit(False).alias("home"))
    return members.unionByName(guests).groupBy("block", "part").applyInPandas(_near_codes(radius), "a bigint, b bigint")


def _block_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks of a later part of the order have larger numbers.
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            number = first + (seen + np.arange(batch.num_rows)) // size
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("fingerprint"), pa.array(number, pa.int64())], ["fingerprint", "block"])

    return run


def _visit_rows(sent, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, directory = sent.value
        for batch in batches:
            codes = batch.column("fingerprint").to_numpy()
            home = batch.column("block").to_numpy()
            who, where = search(directory, codes.view(np.uint64), radius)
            later = numbers[where] >= home[who]
            who, block = who[later], numbers[where[later]]
            columns = [pa.array(codes[who]), pa.array(block), pa.array(block == home[who])]
            yield pa.RecordBatch.from_arrays(columns, ["fingerprint", "block", "home"])

    return run


def _near_codes(radius: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        codes = rows["fingerprint"].to_numpy(np.int64)
        home = rows["home"].to_numpy(bool)
        order = np.argsort(rank_of(codes[home].view(np.uint64)), kind="stable")
        members, guests = codes[home][order], codes[~home]
        who, where = search(build_codes(members.view(np.uint64)), guests.view(np.uint64), radius)
        every, place = np.unique(np.concatenate((members, guests)), return_inverse=True)
        label = representatives(place[len(members) :][who], place[: len(members)][where], len(every))
        moved = np.flatnonzero(label != np.arange(len(every)))
        return pd.DataFrame({"a": every[moved], "b": every[label[moved]]})

    return run


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = similar_fingerprints(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "kept")
