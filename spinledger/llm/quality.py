"""Document quality by a byte-level convolutional network, trained here in numpy."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import is_remainder, training_sample
from .tables import carried, document_rows, extended, prepare, restored, table
from .words import text_chunks

# Fixed values of the contract.
MODULUS, HELD_OUT = 5, 0
THRESHOLD = 0.3
# Labelled documents of each class that the network is fitted on at most.
PER_CLASS = 1500

CHUNK, HOP = 512, 448  # bytes of a chunk; the next begins so many bytes later
WIDTH, STRIDE = 8, 2  # bytes under a filter, and from one place to the next
EMBED, FILTERS = 4, 24
EPOCHS, BATCH, RATE = 8, 32, 0.01
# Chunks that are convolved at once.
AT_ONCE = 256
# Fitted weights are multiples of these, below LIMIT in size. Every product and every sum of
# them then is exact in single precision, so that a response depends on its bytes alone and
# not on what else shares a batch or on the order of summation.
EMBED_STEP, FILTER_STEP, LIMIT = 2.0**-7, 2.0**-8, 3.9


class Network(NamedTuple):
    """Byte vectors, filters with thresholds, and the final layer over pooled responses."""

    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray  # FILTERS
    final: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1


def chunked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes, chunks per text): every byte of every text lies in a chunk.

    Zero bytes fill the last chunk of a text; an empty text is one chunk of them.
    """
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - CHUNK) // HOP) + 1)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = number * HOP
    place = np.arange(CHUNK)
    padded = np.concatenate((data, np.zeros(CHUNK, np.uint8)))
    at = (offsets[text] + start)[:, None] + place
    inside = (start[:, None] + place) < sizes[text][:, None]
    return np.where(inside, padded[np.minimum(at, len(data))], 0).astype(np.uint8), counts


def _windows(network: Network, chunks: np.ndarray) -> np.ndarray:
    """The bytes under each place of the filters (chunks, places, WIDTH * EMBED)."""
    vectors = network.embed[chunks]
    places = (CHUNK - WIDTH) // STRIDE + 1
    step = vectors.strides
    view = np.lib.stride_tricks.as_strided(vectors, (len(chunks), places, WIDTH * EMBED), (step[0], STRIDE * step[1], step[2]))
    return np.ascontiguousarray(view).reshape(-1, WIDTH * EMBED)


def responses(network: Network, chunks: np.ndarray) -> np.ndarray:
    """The largest response of each filter in each chunk (chunks x FILTERS)."""
    return np.maximum(_largest(network, chunks)[0] + network.bias, 0)


def _largest(network: Network, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, place) of the largest product of each filter in each chunk."""
    value = np.empty((len(chunks), FILTERS), network.filters.dtype)
    where = np.empty((len(chunks), FILTERS), np.int64)
    for first in range(0, len(chunks), AT_ONCE):
        part = chunks[first : first + AT_ONCE]
        values = (_windows(network, part) @ network.filters).reshape(len(part), -1, FILTERS)
        at = where[first : first + AT_ONCE] = values.argmax(axis=1)
        value[first : first + AT_ONCE] = np.take_along_axis(values, at[:, None, :], 1)[:, 0, :]
    return value, where


def pooled(pool: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Largest and mean response over the chunks of each text (texts x 2 FILTERS)."""
    starts = np.cumsum(counts) - counts
    return np.concatenate((np.maximum.reduceat(pool, starts), np.add.reduceat(pool, starts) / counts[:, None]), axis=1)


def probabilities(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of label 1 of each text; equal texts get equal ones, whatever lies beside them."""
    chunks, counts = chunked(data, offsets)
    values = pooled(responses(network, chunks).astype(np.float64), counts)
    # Sums in one fixed order.
    logits = np.full(len(counts), float(network.offset[0]))
    for column, weight in enumerate(network.final.tolist()):
        logits += values[:, column] * weight
    return np.array([1.0 / (1.0 + math.exp(-min(max(logit, -40.0), 40.0))) for logit in logits.tolist()])


def _exact(network: Network) -> Network:
    def rounded(values: np.ndarray, step: float) -> np.ndarray:
        return (np.round(np.clip(values, -LIMIT, LIMIT) / step) * step).astype(np.float32)

    bias = rounded(network.bias, EMBED_STEP * FILTER_STEP)
    return network._replace(embed=rounded(network.embed, EMBED_STEP), filters=rounded(network.filters, FILTER_STEP), bias=bias)


def fit(rows: list[tuple[str, int]], share: float, seed: int = 11) -> Network:
    """A network from (text, label) rows; ``share`` is the true share of label 1."""
    rng = np.random.default_rng(seed)
    network = Network(
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        rng.normal(0, 0.25, (WIDTH * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )
    labels = np.array([label for _, label in rows], np.float32)
    share = min(max(share, 0.001), 0.999)
    if len(rows) and 0 < labels.mean() < 1:
        texts = [_chunks(text) for text, _ in rows]
        # Both classes weigh the same while fitting.
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(rows))
            for first in range(0, len(order), BATCH):
                step += 1
                batch = order[first : first + BATCH]
                counts = np.array([len(texts[k]) for k in batch])
                gradients = _gradients(network, np.concatenate([texts[k] for k in batch]), counts, labels[batch], weight[batch])
                rate = RATE * (1 - epoch / EPOCHS) + 1e-4
                for parameter, gradient, (m, v) in zip(network, gradients, moments, strict=True):
                    m += 0.1 * (gradient - m)
                    v += 0.01 * (gradient * gradient - v)
                    parameter -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    # From equal classes back to their true shares.
    network.offset[:] += np.log(share / (1 - share))
    return _exact(network)


def _chunks(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return chunked(data, np.array([0, len(data)]))[0]


def _gradients(network: Network, chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    largest_at, where = _largest(network, chunks)
    raw = largest_at + network.bias
    pool = np.maximum(raw, 0)
    both = pooled(pool, counts)
    error = (1 / (1 + np.exp(-np.clip(both @ network.final + network.offset, -30, 30))) - labels) * weight / len(labels)
    to_final = both.T @ error + 1e-5 * network.final
    back = error[:, None] * network.final
    text = np.repeat(np.arange(len(counts)), counts)
    # The largest chunk of each filter gets the gradient of the maximum, every chunk its part of the mean.
    to_pool = (back[:, FILTERS:] / counts[:, None])[text]
    largest = pool >= both[text, :FILTERS]
    share = np.add.reduceat(largest.astype(np.float32), np.cumsum(counts) - counts)
    to_pool = (to_pool + largest * (back[:, :FILTERS] / share)[text]) * (raw > 0)
    # Only the bytes under the places of the maxima take part in what follows.
    bytes_at = (where * STRIDE)[:, :, None] + np.arange(WIDTH)
    bytes_ = chunks[np.arange(len(chunks))[:, None, None], bytes_at]
    to_filters = np.empty_like(network.filters)
    to_windows = to_pool[:, :, None] * network.filters.T[None]
    for k in range(FILTERS):
        to_filters[:, k] = network.embed[bytes_[:, k]].reshape(len(chunks), -1).T @ to_pool[:, k]
    to_embed = np.zeros_like(network.embed)
    parts = to_windows.reshape(-1, EMBED)
    for k in range(EMBED):
        to_embed[:, k] = np.bincount(bytes_.reshape(-1), parts[:, k], minlength=256)
    return to_embed, to_filters, to_pool.sum(axis=0), to_final.astype(np.float32), np.array([error.sum()], np.float32)


def quality_scores(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (probability of label 1) and predicted, from whole texts.

    A null text scores as an empty one. Every row is scored by itself, whatever its
    doc_id or neighbours, so equal texts get equal scores; columns of ``docs`` called score
    or predicted are replaced. Every byte of a very long text takes part, 256 chunks at a
    time. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    names, inner = carried(docs, ("score", "predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(network)
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for first, data, offsets in text_chunks(batch.column(text), 1 << 18):
                scores[first : first + len(offsets) - 1] = probabilities(sent.value, data, offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    scored = inner.mapInArrow(run, extended(inner, "score double"))
    return scored.select(
        *restored(names),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def fitted_network(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    """Learns from labels of rows that are not held out, all bytes of each text.

    At most ``per_class`` texts of each class, and of both together no more than the bytes
    that ``training_sample`` allows. Without labels the network gives the same score to all.
    """
    rows, share = training_sample(docs, labels, "quality", MODULUS, HELD_OUT, per_class)
    return fit(rows, share)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(document_rows(docs), fitted_network(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_remainder(MODULUS, HELD_OUT).alias("held_out"), "score", "predicted")
