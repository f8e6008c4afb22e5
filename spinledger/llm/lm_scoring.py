"""Log probabilities of whole documents: corpus word counts and a recurrent model."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from tempfile import SpooledTemporaryFile
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru
from .labelled import is_remainder
from .tables import document_rows, prepare, stored, table
from .words import SPACES, binary_array, text_chunks, words_of

# Fixed values of the contract.
MODULUS, HELD_OUT = 5, 1
# The hash that stands for the end of a text.
END_KEY = -1
# Words the recurrent model tells apart; all others share one number and their counts.
MODEL_WORDS = 4096
# The most frequent words, whose counts every task holds: 16 bytes each.
HEAD_WORDS = 1 << 17
# Training tokens of a shard, up to so many shards; beyond, each has more.
SHARD_TOKENS, MOST_SHARDS = 1 << 21, 24
# Every training token is learned from so many times. A corpus of more than one shard is worked through
# in so many folds, after each of which the weights of the shards are averaged.
PASSES, FOLDS = 3, 4
# Tokens that a task cuts into parallel streams at once, and pieces that weights travel in.
FIT_TOKENS, WEIGHT_PIECES = 1 << 21, 16
# Documents that run through the model side by side, and their bytes at most.
TOGETHER, TOGETHER_BYTES = 8000, 16 << 20

_NUMBERED = """row bigint, doc_id bigint, held_out boolean, hash bigint, n_tokens bigint, n_known bigint, base double,
  extra double, numbers binary, rare_keys binary, rare_counts binary"""
_DONE = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"


class Scorer(NamedTuple):
    """What a task needs to score texts."""

    model: gru.Model
    head_keys: np.ndarray  # sorted hashes of the most frequent words
    head_counts: np.ndarray
    head_numbers: np.ndarray  # their model number, or that of all others
    total: int
    base_denominator: float
    rare_denominator: float

    @property
    def other(self) -> int:
        return len(self.model.inputs) - 2

    @property
    def end(self) -> int:
        return len(self.model.inputs) - 1


def token_counts(docs: DataFrame) -> DataFrame:
    """(key, c): how often each word, and the end of a text, occurs in (text) rows.

    Words are 64-bit hashes. Each task sums up its batches before the shuffle.
    """
    counted = docs.select("text").mapInArrow(_count_rows, "key bigint, c bigint")
    return counted.groupBy("key").agg(F.sum("c").alias("c"))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [words_of(data, offsets, SPACES).key for _, data, offsets in text_chunks(batch.column("text"))]
        keys, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_counts=True)
        keys = np.concatenate((keys.view(np.int64), [END_KEY]))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate((counts, [batch.num_rows])))], ["key", "c"])


def start_scorer(counts: DataFrame) -> Scorer:
    """A scorer from the counts of all words of the training documents; its model has yet to learn.

    Only ``HEAD_WORDS`` counts reach the driver. The model's words are the most frequent ones; a
    word beyond them has the probability that the model gives to any such word, times its
    share by count.
    """
    row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = int(row["n"]), int(row["v"])
    head = _head_words(counts.where(F.col("key") != END_KEY))
    ends = counts.where(F.col("key") == END_KEY).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    keys = np.array([r["key"] for r in head] + [END_KEY], np.int64)
    head_counts = np.array([r["c"] for r in head] + [ends], np.int64)
    words = min(MODEL_WORDS - 2, len(head))
    others = total - int(head_counts[:words].sum()) - int(ends)
    model_counts = np.concatenate((head_counts[:words], [others, ends])).astype(float)
    model = gru.start_model(model_counts)
    numbers = np.minimum(np.arange(len(keys)), words)
    numbers[-1] = words + 1
    order = np.argsort(keys.view(np.uint64))
    return Scorer(
        model,
        keys.view(np.uint64)[order],
        head_counts[order],
        numbers[order],
        total,
        total + 0.5 * (distinct + 1),
        others + 0.5 * (max(distinct - words - 1, 0) + 1),
    )


def _head_words(counts: DataFrame) -> list:
    """The ``HEAD_WORDS`` rows of the largest counts, ties to smaller keys.

    Words far below the last of them are left out first, so that not every partition sends as many.
    """
    order = F.floor(F.log2("c"))
    least, words = 0, 0
    for row in sorted(counts.groupBy(order.alias("order")).count().collect(), reverse=True):
        least, words = row["order"], words + row["count"]
        if words >= HEAD_WORDS:
            break
    return counts.where(order >= least).orderBy(F.desc("c"), "key").limit(HEAD_WORDS).collect()


def fitted_model(model: gru.Model, texts: DataFrame, total: int) -> tuple[gru.Model, int]:
    """(the model after learning from all (hash, numbers) rows, tokens dealt out in all rounds).

    ``total`` is the number of tokens. Each row belongs to a shard by its hash, which is learned
    from on its own, row by row in the order of the hashes; the weights of all shards are averaged by
    their tokens. Every token is learned from ``PASSES`` times, whatever the size of the corpus: one shard is
    dealt out once per pass, several are dealt out once, and each goes through its part of a fold in all
    passes before the weights are averaged. Nothing of this depends on how the rows were stored or dealt
    to tasks.
    """
    spark = texts.sparkSession
    shards = min(MOST_SHARDS, -(-total // SHARD_TOKENS))
    rounds, passes = (PASSES, 1) if shards == 1 else (FOLDS if shards else 0, PASSES)
    learned = 0
    for number in range(rounds):
        own = texts if shards == 1 else texts.where(F.pmod("hash", F.lit(FOLDS)) == number)
        # Other bits than those of the fold. More partitions than shards, so that few hold two.
        shard = F.pmod(F.shiftright("hash", 8), F.lit(shards)).cast("int").alias("shard")
        dealt = own.select(shard, "hash", "numbers").repartition(4 * shards, "shard").sortWithinPartitions("shard", "hash", "numbers")
        rates = [gru.RATE * (1 - (number + again / passes) / rounds) for again in range(passes)]
        task = _fit_rows(spark.sparkContext.broadcast(model), rates)
        pieces = dealt.select("shard", "numbers").mapInArrow(task, "shard int, piece int, tokens bigint, weights binary")
        means = pieces.groupBy("piece").applyInPandas(_mean_weights, "piece int, tokens bigint, weights binary").collect()
        if not means:
            # A fold may be without rows.
            continue
        means.sort(key=lambda row: row["piece"])
        flat = np.concatenate([np.frombuffer(row["weights"], np.float32) for row in means])
        ends = np.cumsum([weights.size for weights in model])[:-1]
        model = gru.Model(*(own.reshape(weights.shape) for weights, own in zip(model, np.split(flat, ends), strict=True)))
        learned += means[0]["tokens"]
    return model, learned


def _fit_rows(sent, rates: list[float]):
    """Learns from the rows of each shard once per rate; above ``FIT_TOKENS`` they wait in a local file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in groupby(_shard_parts(batches), key=lambda part: part[0]):
            model = gru.Model(*(weights.copy() for weights in sent.value))
            fitting, size = gru.Fitting(model), 2 * FIT_TOKENS
            with SpooledTemporaryFile(size) as kept:
                tokens = sum(kept.write(numbers.tobytes()) for _, numbers in parts) // 2
                for rate in rates:
                    kept.seek(0)
                    while numbers := kept.read(size):
                        fitting.run(np.frombuffer(numbers, np.int16), len(model.inputs) - 1, rate)
            pieces = np.array_split(np.concatenate([weights.ravel() for weights in model]), WEIGHT_PIECES)
            columns = [
                pa.array([shard] * WEIGHT_PIECES, pa.int32()),
                pa.array(range(WEIGHT_PIECES), pa.int32()),
                pa.array([tokens] * WEIGHT_PIECES, pa.int64()),
                pa.array([piece.tobytes() for piece in pieces], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "piece", "tokens", "weights"])

    return run


def _shard_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, word numbers) for the rows of each shard in each batch."""
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        numbers, offsets = _numbers_of(batch.column("numbers"))
        for shard, first, rows in zip(*np.unique(shards, return_index=True, return_counts=True), strict=True):
            yield int(shard), numbers[offsets[first] : offsets[first + rows]]


def _mean_weights(rows):
    rows = rows.sort_values("shard")
    tokens = int(rows["tokens"].sum())
    mean = sum(np.frombuffer(own, np.float32) * (n / tokens) for own, n in zip(rows["weights"], rows["tokens"], strict=True))
    return rows.head(1).assign(tokens=tokens, weights=[mean.astype(np.float32).tobytes()])[["piece", "tokens", "weights"]]


def _numbers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all rows, offsets) of a column of ``numbers``."""
    column = column.cast(pa.large_binary())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1] // 2
    data = np.frombuffer(data_buffer, np.int16, offsets[-1]) if data_buffer else np.empty(0, np.int16)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _numbered(scorer: Scorer, data: np.ndarray, offsets: np.ndarray):
    """(model numbers with ends, word keys, offsets with ends, whether in the head, place there)."""
    words = words_of(data, offsets, SPACES)
    texts = len(offsets) - 1
    at = np.minimum(np.searchsorted(scorer.head_keys, words.key), len(scorer.head_keys) - 1)
    held = scorer.head_keys[at] == words.key
    sizes = np.bincount(words.doc, minlength=texts) + 1
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    numbers = np.full(bounds[-1], scorer.end)
    numbers[np.arange(len(words.key)) + words.doc] = np.where(held, scorer.head_numbers[at], scorer.other)
    return numbers, words, bounds, held, at


def scored_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Learns from the rows that are not held out. ``base_score`` sums the log10 of smoothed
    word frequencies, ``score`` is the recurrent model's log10 probability of the whole
    text up to and including its end. The state is carried from window to window. The model learns
    from every token of the training rows, ``PASSES`` times.

    Words beyond the ``HEAD_WORDS`` most frequent meet their counts by a join; only they
    are shuffled, and none of them can be hot. A null text is an empty one: its end alone.
    A row without doc_id is learned from and scored. Rows that repeat a doc_id are scored
    one by one. Other columns are ignored; without training rows all counts are zero.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = document_rows(docs).withColumn("held_out", is_remainder(MODULUS, HELD_OUT))
    counts = stored(token_counts(rows.where(~F.col("held_out"))), "token-counts")
    scorer = start_scorer(counts)
    hashed = rows.withColumn("hash", F.xxhash64("doc_id", "text"))
    numbered = stored(hashed.mapInArrow(_number_rows(spark.sparkContext.broadcast(scorer)), _NUMBERED), "numbered")
    model, _ = fitted_model(scorer.model, numbered.where(~F.col("held_out")).select("hash", "numbers"), scorer.total)
    known = numbered.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "extra", "numbers")
    done = stored(known.mapInArrow(_score_rows(spark.sparkContext.broadcast(model)), _DONE), "scored")
    rare = numbered.where(F.length("rare_keys") > 0).select("row", "rare_keys", "rare_counts").mapInArrow(_rare_rows, "row bigint, key bigint, n bigint")
    found = rare.join(counts, "key", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    shares = found.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("logs"),
        F.sum("n").alias("n_rare"),
    )
    n_rare = F.coalesce(F.col("n_rare"), F.lit(0))
    logs = F.coalesce(F.col("logs"), F.lit(0.0))
    return (
        done.join(shares, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce(F.col("known"), F.lit(0))).alias("n_known"),
            F.lit(scorer.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + logs - n_rare * F.lit(float(np.log10(scorer.base_denominator)))).alias("base_score"),
            (F.col("score") + logs - n_rare * F.lit(float(np.log10(scorer.rare_denominator)))).alias("score"),
        )
    )


def _number_rows(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield _counted(sent.value, batch, number)
            number += batch.num_rows

    return run


def _counted(scorer: Scorer, texts: pa.RecordBatch, number: int) -> pa.RecordBatch:
    count = texts.num_rows
    n_tokens, n_known, base = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count)
    rare_keys, rare_counts = [b""] * count, [b""] * count
    head_known = scorer.head_counts > 0
    head_logs = np.log10(scorer.head_counts + 0.5)
    log_base = np.log10(scorer.base_denominator)
    # Among the words that the model does not tell apart, those of the head are known here.
    shares = np.where(scorer.head_numbers == scorer.other, head_logs - np.log10(scorer.rare_denominator), 0.0)
    extra = np.zeros(count)
    streams = [np.empty(0, np.int16)]
    end_at = int(np.searchsorted(scorer.head_keys, np.uint64(2**64 - 1)))
    for first, data, offsets in text_chunks(texts.column("text")):
        numbers, words, bounds, held, at = _numbered(scorer, data, offsets)
        here = slice(first, first + len(offsets) - 1)
        texts_here = len(offsets) - 1
        n_tokens[here] = np.diff(bounds)
        end_known = int(head_known[end_at])
        doc, place = words.doc[held], at[held]
        n_known[here] = np.bincount(doc, head_known[place], minlength=texts_here) + end_known
        base[here] = np.bincount(doc, head_logs[place] - log_base, minlength=texts_here) + head_logs[end_at] - log_base
        extra[here] = np.bincount(doc, shares[place], minlength=texts_here)
        far = np.flatnonzero(~held)
        edges = np.searchsorted(words.doc[far], np.arange(texts_here + 1))
        for k in np.flatnonzero(np.diff(edges)):
            keys, times = np.unique(words.key[far[edges[k] : edges[k + 1]]], return_counts=True)
            rare_keys[first + k], rare_counts[first + k] = keys.tobytes(), times.astype(np.int32).tobytes()
        streams.append(numbers.astype(np.int16))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(number + np.arange(count)),
            texts.column("doc_id"),
            texts.column("held_out"),
            texts.column("hash"),
            pa.array(n_tokens),
            pa.array(n_known),
            pa.array(base),
            pa.array(extra),
            binary_array(np.concatenate(streams), n_tokens),
            pa.array(rare_keys, pa.binary()),
            pa.array(rare_counts, pa.binary()),
        ],
        ["row", "doc_id", "held_out", "hash", "n_tokens", "n_known", "base", "extra", "numbers", "rare_keys", "rare_counts"],
    )


def _score_rows(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                gathered.append(batch)
            if sum(b.num_rows for b in gathered) >= TOGETHER or sum(b.nbytes for b in gathered) >= TOGETHER_BYTES:
                yield _scored(sent.value, gathered)
                gathered = []
        if gathered:
            yield _scored(sent.value, gathered)

    return run


def _scored(model: gru.Model, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    numbers, offsets = _numbers_of(rows.column("numbers"))
    score = gru.score_texts(model, numbers.astype(np.int64), offsets, len(model.inputs) - 1) / np.log(10) + rows.column("extra").to_numpy()
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]
    return pa.RecordBatch.from_arrays([*(rows.column(name) for name in names), pa.array(score)], [*names, "score"])


def _rare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [np.frombuffer(own, np.int32) for own in batch.column("rare_counts").to_pylist()]
        keys = np.frombuffer(b"".join(batch.column("rare_keys").to_pylist()), np.int64)
        rows = np.repeat(batch.column("row").to_numpy(), [len(own) for own in counts])
        times = np.concatenate([np.empty(0, np.int32), *counts]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(keys), pa.array(times)], ["row", "key", "n"])


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_documents(table(spark, sf_dir, "documents"))
