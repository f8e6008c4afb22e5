"""Toxicity by the nearest labelled documents: exact TF-IDF cosine over a block-max index."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import is_remainder, training_sample
from .tables import carried, document_rows, extended, prepare, restored, table
from .words import NOT_ALPHANUMERIC, distinct_by_text, text_chunks, words_of

# Fixed values of the contract.
MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.3
# Labelled documents of each class that the index holds at most, and its words at most.
PER_CLASS = 3000
VOCABULARY = 4096
# A word counts if so many labelled documents hold it, labels differ with it by this
# chi-square, and it changes their odds by this factor.
LEAST_DOCUMENTS = 5
LEAST_CHI_SQUARE = 25.0
LEAST_ODDS = 4.0
BLOCK = 64
NEIGHBOURS = 15
# Blocks with the highest bounds that are always evaluated, before the bounds decide.
FIRST_BLOCKS = 3


class Index(NamedTuple):
    """Postings of the labelled documents, cut into blocks with the largest weight in each."""

    vocabulary: np.ndarray  # sorted word hashes
    idf: np.ndarray
    pointers: np.ndarray  # words x (blocks + 1): where a word's postings of a block begin
    posting_doc: np.ndarray
    posting_weight: np.ndarray
    block_max: np.ndarray  # words x blocks
    label: np.ndarray
    weight: np.ndarray  # how many real documents an example stands for, relatively
    share: float  # of label 1
    slope: np.ndarray  # calibration: intercept and factor of the logit of the vote


def _term_counts(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray):
    """(text, word number, count) of the known words, sorted."""
    words = words_of(data, offsets, NOT_ALPHANUMERIC)
    if not len(vocabulary) or not len(words.key):
        nothing = np.empty(0, np.int64)
        return nothing, nothing, nothing
    at = np.minimum(np.searchsorted(vocabulary, words.key), len(vocabulary) - 1)
    known = vocabulary[at] == words.key
    code, counts = np.unique(words.doc[known] * len(vocabulary) + at[known], return_counts=True)
    return code // len(vocabulary), code % len(vocabulary), counts


def _unit_vectors(text: np.ndarray, word: np.ndarray, counts: np.ndarray, idf: np.ndarray, texts: int) -> np.ndarray:
    weights = (1.0 + np.log(counts)) * idf[word]
    norms = np.sqrt(np.bincount(text, weights * weights, minlength=texts))
    return weights / norms[text]


def build_index(rows: list[tuple[str, int]], share: float) -> Index:
    """An index of (text, label) examples; ``share`` is the true share of label 1."""
    texts = pa.array([text for text, _ in rows], pa.string())
    label = np.array([label for _, label in rows], np.int64)
    share = min(max(share, 0.001), 0.999)
    vocabulary = _chosen_words(texts, label)
    parts = []
    for first, data, offsets in text_chunks(texts):
        text, word, counts = _term_counts(data, offsets, vocabulary)
        parts.append((text + first, word, counts))
    text, word, counts = (np.concatenate([np.empty(0, np.int64), *(part[k] for part in parts)]) for k in range(3))
    held = np.bincount(word, minlength=len(vocabulary))
    idf = np.log((len(rows) + 1) / (held + 1)) + 1.0
    values = _unit_vectors(text, word, counts, idf, len(rows))
    # Documents that share their weightiest word lie side by side, so that bounds of blocks are tight.
    order = np.lexsort((-values, text))
    heads = np.full(len(rows), len(vocabulary))
    first_of = np.unique(text[order], return_index=True)
    heads[first_of[0]] = word[order][first_of[1]]
    place = np.empty(len(rows), np.int64)
    place[np.lexsort((np.arange(len(rows)), label, heads))] = np.arange(len(rows))
    label_at = np.empty_like(label)
    label_at[place] = label
    blocks = max(1, -(-len(rows) // BLOCK))
    doc = place[text] if len(text) else text
    order = np.lexsort((doc, word))
    doc, word, values = doc[order], word[order], values[order]
    pointers = np.searchsorted(word * blocks + doc // BLOCK, np.arange(len(vocabulary) * blocks))
    pointers = np.concatenate((pointers.reshape(len(vocabulary), blocks), np.searchsorted(word, np.arange(len(vocabulary)), side="right")[:, None]), axis=1)
    block_max = np.zeros((len(vocabulary), blocks))
    np.maximum.at(block_max, (word, doc // BLOCK), values)
    ones = max(label.mean(), 1e-9) if len(label) else 1.0
    weight = np.where(label_at == 1, share / ones, (1 - share) / max(1 - ones, 1e-9))
    index = Index(vocabulary, idf, pointers, doc, values, block_max, label_at, weight, share, np.array([0.0, 1.0]))
    return index._replace(slope=_calibrated(index, rows, place))


def _chosen_words(texts: pa.Array, label: np.ndarray) -> np.ndarray:
    """The words whose presence goes with the label most, from the labelled texts alone."""
    keys, of_ones = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for first, data, offsets in text_chunks(texts):
        words = words_of(data, offsets, NOT_ALPHANUMERIC)
        own, ends = distinct_by_text(words.doc, words.key, len(offsets) - 1)
        keys.append(own)
        of_ones.append(np.repeat(label[first : first + len(offsets) - 1], np.diff(ends)))
    words, inverse, held = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    if not len(words):
        return words
    ones = np.bincount(inverse, np.concatenate(of_ones))
    total, total_ones = len(label), label.sum()
    expected = held * total_ones / total
    spread = expected * (1 - total_ones / total) * (1 - held / total)
    chi_square = np.where(spread > 0, (ones - expected) ** 2 / np.maximum(spread, 1e-12), 0)
    # Odds of label 1 with the word against those of all examples: common words that merely
    # go with longer texts say little and would make every example a neighbour of every text.
    odds = (ones + 0.5) / (held - ones + 0.5) * (total - total_ones + 0.5) / (total_ones + 0.5)
    telling = (odds >= LEAST_ODDS) | (odds <= 1 / LEAST_ODDS)
    good = np.flatnonzero((held >= LEAST_DOCUMENTS) & (chi_square >= LEAST_CHI_SQUARE) & telling)
    best = good[np.argsort(-chi_square[good], kind="stable")[:VOCABULARY]]
    return np.sort(words[best])


def nearest(index: Index, word: np.ndarray, values: np.ndarray, k: int = NEIGHBOURS, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """(examples, cosines) of the ``k`` nearest with any common word, nearest first.

    A block's bound is the query against the largest weights of the block. The blocks with
    the highest bounds are evaluated first, then all whose bound reaches the k-th cosine
    found so far: no example outside them can be nearer, so the result is exact.
    """
    bounds = values @ index.block_max[word]
    order = np.argsort(-bounds, kind="stable")
    scores = np.zeros(len(index.label))
    _add_scores(index, word, values, order[:FIRST_BLOCKS], scores)
    if skip >= 0:
        scores[skip] = 0
    limit = np.partition(scores, -k)[-k] if len(scores) > k else 0.0
    rest = order[FIRST_BLOCKS:]
    rest = rest[(bounds[rest] >= limit - 1e-12) & (bounds[rest] > 0)]
    if len(rest):
        _add_scores(index, word, values, rest, scores)
        if skip >= 0:
            scores[skip] = 0
    found = np.flatnonzero(scores > 0)
    top = found[np.lexsort((found, -scores[found]))[:k]]
    return top, scores[top]


def _add_scores(index: Index, word: np.ndarray, values: np.ndarray, blocks: np.ndarray, scores: np.ndarray) -> None:
    begin = index.pointers[word[:, None], blocks].reshape(-1)
    count = index.pointers[word[:, None], blocks + 1].reshape(-1) - begin
    total = int(count.sum())
    if not total:
        return
    at = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
    of_query = np.repeat(np.repeat(values, len(blocks)), count)
    np.add.at(scores, index.posting_doc[at], index.posting_weight[at] * of_query)


def _vote(index: Index, examples: np.ndarray, cosines: np.ndarray) -> float:
    """Share of label 1 among the neighbours, by nearness, with one vote for the true share."""
    # Nearness falls with the angle's distance 1 - cos; an identical example counts most.
    near = index.weight[examples] / (1.05 - np.minimum(cosines, 1.0))
    return (near @ index.label[examples] + index.share) / (near.sum() + 1.0)


def _calibrated(index: Index, rows: list[tuple[str, int]], place: np.ndarray) -> np.ndarray:
    """Intercept and factor for the logit of the vote, fitted with each example left out."""
    votes = np.full(len(rows), index.share)
    for first, data, offsets in text_chunks(pa.array([text for text, _ in rows], pa.string())):
        for text, word, values in _queries(index, data, offsets):
            examples, cosines = nearest(index, word, values, skip=int(place[first + text]))
            votes[first + text] = _vote(index, examples, cosines)
    label = np.array([label for _, label in rows], float)
    if not len(rows) or label.min() == label.max():
        return np.array([0.0, 1.0])
    x = np.stack((np.ones(len(rows)), _logit(votes)), axis=1)
    weight = index.weight[place]
    slope = np.array([0.0, 1.0])
    for _ in range(25):  # Newton steps, held back by a weak prior at the start values
        p = 1 / (1 + np.exp(-np.clip(x @ slope, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + 1e-2 * (slope - np.array([0.0, 1.0]))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        slope = slope - np.linalg.solve(hessian, gradient)
    return slope if np.isfinite(slope).all() and slope[1] > 0 else np.array([0.0, 1.0])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _queries(index: Index, data: np.ndarray, offsets: np.ndarray):
    """(text, words, unit vector) of the texts that hold any word of the vocabulary."""
    text, word, counts = _term_counts(data, offsets, index.vocabulary)
    values = _unit_vectors(text, word, counts, index.idf, len(offsets) - 1)
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(text)), bool), text[1:] != text[:-1])))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(text)], strict=False):
        yield int(text[a]), word[a:b], values[a:b]


def toxicity_scores(docs: DataFrame, index: Index, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted and evidence, from whole texts.

    ``evidence`` lists (label, cosine) of the nearest examples. A text without any word of
    the index, such as an empty or null one, has no neighbours and scores the calibrated
    share of label 1. Rows are scored one by one; columns of ``docs`` with the names of the
    added ones are replaced.
    """
    prepare(docs.sparkSession)
    names, inner = carried(docs, ("score", "predicted", "evidence"))
    sent = docs.sparkSession.sparkContext.broadcast(index)
    column = names.index("text")
    evidence_type = pa.list_(pa.struct([("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            votes = np.full(batch.num_rows, index.share)
            evidence: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, data, offsets in text_chunks(batch.column(column)):
                for text, word, values in _queries(index, data, offsets):
                    examples, cosines = nearest(index, word, values)
                    votes[first + text] = _vote(index, examples, cosines)
                    evidence[first + text] = [
                        {"label": label, "cosine": cosine} for label, cosine in zip(index.label[examples].tolist(), cosines.tolist(), strict=True)
                    ]
            scores = 1 / (1 + np.exp(-np.clip(index.slope[0] + index.slope[1] * _logit(votes), -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array(evidence, evidence_type)], [*batch.schema.names, "score", "evidence"]
            )

    scored = inner.mapInArrow(run, extended(inner, "score double, evidence array<struct<label:int,cosine:double>>"))
    return scored.select(
        *restored(names),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        "evidence",
    )


def fitted_index(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Index:
    """Learns from labels of rows that are not held out, at most ``per_class`` of each class."""
    rows, share = training_sample(docs, labels, "toxic", MODULUS, HELD_OUT, per_class)
    return build_index(rows, share)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity_scores(document_rows(docs), fitted_index(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_remainder(MODULUS, HELD_OUT).alias("held_out"), "score", "predicted", "evidence")
