"""Benchmark passages in documents, found with a generalised suffix automaton."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .suffix_automaton import SuffixAutomaton
from .tables import carried, extended, prepare, restored, stored, table
from .words import NOT_ALPHANUMERIC, text_chunks, words_of

# Fixed value of the contract: words of a window.
WINDOW = 10
# Items are matched in blocks of about so many bytes, each small enough to be broadcast.
BLOCK_BYTES = 4 << 20


class Matcher(NamedTuple):
    """What a task needs to find the windows of a block of items."""

    automaton: SuffixAutomaton
    vocabulary: np.ndarray  # sorted hashes of the items' words
    pairs: np.ndarray  # sorted codes of adjacent words
    shortest: int  # words of the shortest window

    @classmethod
    def of(cls, names: list[str], texts: list[str | None], window: int) -> Matcher:
        words = [np.empty(0, np.uint64)] * len(names)
        for first, data, offsets in text_chunks(pa.array(texts, pa.string())):
            found = words_of(data, offsets, NOT_ALPHANUMERIC)
            bounds = np.searchsorted(found.doc, np.arange(len(offsets)))
            for k in range(len(offsets) - 1):
                words[first + k] = found.key[bounds[k] : bounds[k + 1]]
        vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *words]))
        automaton = SuffixAutomaton(window)
        pairs, shortest = [np.empty(0, np.int64)], window
        for name, keys in zip(names, words, strict=True):
            ids = np.searchsorted(vocabulary, keys)
            automaton.add(name, ids.tolist())
            pairs.append(ids[:-1] * len(vocabulary) + ids[1:])
            if len(ids):
                shortest = min(shortest, len(ids))
        return cls(automaton.finish(), vocabulary, np.unique(np.concatenate(pairs)), shortest)


def _held(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each value is among the sorted ones, its place)."""
    if not len(among):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values, at


def _windows(matcher: Matcher, doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, dict[int, set[str]]]:
    """(whether each word is hit, items found by text) for the words of a chunk.

    A window can only lie in a run of words whose neighbours are all neighbours in some
    item too. Only such runs of sufficient length go through the automaton, which is at
    its start between them anyway.
    """
    hit = np.zeros(len(keys) + 1, np.int32)
    items: dict[int, set[str]] = {}
    known, ids = _held(keys, matcher.vocabulary)
    if matcher.shortest > 1:
        joined = known[:-1] & known[1:] & (doc[:-1] == doc[1:])
        at = np.flatnonzero(joined)
        good, _ = _held(ids[at] * len(matcher.vocabulary) + ids[at + 1], matcher.pairs)
        joined[at[~good]] = False
        first, last = _runs(joined)
        last = last + 1  # n joints hold n + 1 words together
    else:
        cut = np.concatenate((doc[1:] != doc[:-1], [True])) if len(doc) else np.empty(0, bool)
        first, last = _runs(known, cut)
    enough = last - first + 1 >= matcher.shortest
    for a, b in zip(first[enough].tolist(), last[enough].tolist(), strict=True):
        for position, size, names in matcher.automaton.matches(ids[a : b + 1].tolist()):
            hit[a + position - size + 1] += 1
            hit[a + position + 1] -= 1
            items.setdefault(int(doc[a]), set()).update(names)
    return np.cumsum(hit[:-1]) > 0, items


def _runs(flags: np.ndarray, cut_after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of runs of true flags; no run goes on over a cut."""
    if not len(flags):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins = flags & ~np.concatenate(([False], flags[:-1]))
    ends = flags & ~np.concatenate((flags[1:], [False]))
    if cut_after is not None:
        ends |= flags & cut_after
        begins[1:] |= flags[1:] & cut_after[:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends)


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, cut_text: bool = True) -> DataFrame:
    """``docs`` with the passages they share with benchmark items cut out of ``text``.

    Adds n_words, n_hit (words inside an occurrence of a window) and items (sorted ids, as
    strings, of the items found). Words are runs of ASCII letters, digits and everything
    beyond ASCII, in lower case. With ``cut_text`` off the text stays as it is.

    Items come as (item_id, text); a null text has no words and items without an id are
    left out, as are repeated ids beyond their texts: an id is found if any of its texts
    is. Documents: a null text has no words and stays null. Rows are independent, so
    repeated doc_ids and extra columns make no difference; columns of ``docs`` with the
    names of the added ones are replaced. Without items nothing is hit.

    Items are matched block by block: each block is collected and broadcast only because
    its size is bounded, and a large benchmark means more passes over the documents.
    """
    prepare(docs.sparkSession)
    named = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = named.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    names, inner = carried(docs, ("n_words", "n_hit", "items"))
    text = f"c{names.index('text')}"
    found = inner.withColumns({"n_words": F.lit(0).cast("bigint"), "spans": F.lit(b""), "items": F.lit(None).cast("array<string>")})
    whole = extended(inner, "n_words bigint, spans binary, items array<string>")
    for block in range(blocks):
        part = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        matcher = Matcher.of([row["item_id"] for row in part], [row["text"] for row in part], window)
        match = _matching_rows(docs.sparkSession.sparkContext.broadcast(matcher), text)
        if block < blocks - 1:
            found = stored(found.mapInArrow(match, whole), "block-matches")
    # The last block is matched and the text cut in one pass through Python.
    last, cut = match, _cutting_rows(text, cut_text)
    done = found.mapInArrow(lambda batches: cut(last(batches)), extended(inner, "n_words bigint, n_hit bigint, items array<string>"))
    return done.select(*restored(names), "n_words", "n_hit", "items")


def _matching_rows(sent, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = sent.value
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            spans: list[bytes] = batch.column("spans").to_pylist()
            items = [set(own or ()) for own in batch.column("items").to_pylist()]
            for first, data, offsets in text_chunks(batch.column(text_column)):
                words = words_of(data, offsets, NOT_ALPHANUMERIC)
                n_words[first : first + len(offsets) - 1] = np.bincount(words.doc, minlength=len(offsets) - 1)
                hit, found = _windows(matcher, words.doc, words.key)
                for doc, names in found.items():
                    items[first + doc] |= names
                    a, b = np.searchsorted(words.doc, [doc, doc + 1])
                    # A span: number of its first and last word, and its first and last byte.
                    at = np.stack(_runs(hit[a:b]), axis=1)
                    bytes_ = np.stack((words.start[a + at[:, 0]], words.end[a + at[:, 1]]), axis=1) - offsets[doc]
                    spans[first + doc] += np.concatenate((at, bytes_), axis=1).astype(np.int64).tobytes()
            names = batch.schema.names
            columns = [batch.column(k) for k in range(batch.num_columns - 3)]
            added = [pa.array(n_words), pa.array(spans, pa.binary()), pa.array([sorted(own) for own in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, *added], names)

    return run


def merged_spans(packed: bytes) -> np.ndarray:
    """Spans (first word, last word, first byte, end byte) with overlaps and neighbours joined."""
    spans = np.frombuffer(packed, np.int64).reshape(-1, 4)
    merged: list[list[int]] = []
    for first, last, start, end in sorted(spans.tolist()):
        if merged and first <= merged[-1][1] + 1:
            if last > merged[-1][1]:
                merged[-1][1], merged[-1][3] = last, end
        else:
            merged.append([first, last, start, end])
    return np.array(merged, np.int64).reshape(-1, 4)


def _cutting_rows(text_column: str, cut_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(k) for k in range(batch.num_columns)]
            at, spans_at = names.index(text_column), names.index("spans")
            hits, texts = [], columns[at].to_pylist() if cut_text else None
            for row, packed in enumerate(columns[spans_at].to_pylist()):
                spans = merged_spans(packed) if packed else np.empty((0, 4), np.int64)
                hits.append(int((spans[:, 1] - spans[:, 0] + 1).sum()))
                if cut_text and len(spans):
                    data, rest, done = texts[row].encode(), [], 0
                    for start, end in spans[:, 2:].tolist():
                        rest.append(data[done:start])
                        done = end
                    texts[row] = b"".join([*rest, data[done:]]).decode()
            if cut_text:
                columns[at] = pa.array(texts, columns[at].type)
            columns[spans_at] = pa.array(hits, pa.int64())
            names[spans_at] = "n_hit"
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminated(docs, table(spark, sf_dir, "benchmark"), cut_text=False)
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = """
with words as (
  select 'd' as side, row_number() over () as rid, doc_id as id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
  union all
  select 'b', row_number() over (), item_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
  from benchmark where item_id is not null
), item_windows as (
  select distinct cast(id as varchar) as item, least(len(w), 10) as n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as s
  from (select id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from words where side = 'b' and len(w) > 0)
), sizes as (
  select distinct n from item_windows
), doc_windows as (
  select rid, n, i, array_to_string(w[i : i + n - 1], ' ') as s
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where side = 'd' and len(w) >= n)
), found as (
  select d.rid, d.i, d.n, b.item from doc_windows d join item_windows b on d.n = b.n and d.s = b.s
), hits as (
  select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from found) group by rid
), items as (
  select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct rid, item from found) group by rid
)
select w.id as doc_id, len(w.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join hits h on w.rid = h.rid left join items t on w.rid = t.rid where w.side = 'd'
"""
