"""Spelling variants: words one edit apart, found by k-d trees over their letter counts."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .count_tree import code_points, home_leaves, leaves_within, letter_counts, one_edit_apart, pairs_within, partition
from .tables import document_rows, hashed_sample, prepare, stored, table

# Fixed values of the contract: least length and count of a word, how much more frequent
# its form has to be, and the divisor that marks runs to be misspelt.
MIN_LENGTH, MIN_COUNT, TIMES, MISSPELT = 6, 5, 5, 199
# Words whose letter counts the upper trees are fitted on, and words of a leaf at most by that sample.
SAMPLE_WORDS, LEAF_WORDS = 65_536, 8192
# Words of a block, and words that search it in one task.
BLOCK_WORDS, SEARCHERS = 16_384, 131_072
# Different words a task counts before it hands on what it has.
COUNTED = 200_000

# Letters as UTF-8: a-z, and U+00C0 to U+00FF, which all begin with the byte C3.
_LETTERS = re.compile(rb"(?:[a-z]|\xC3[\x80-\xBF])+")
_ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint32)


def word_counts(docs: DataFrame, misspelt: int | None = None) -> DataFrame:
    """(word, n): lower-cased runs of letters in whole texts and how often they occur.

    Letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. With ``misspelt``,
    a run loses one letter wherever that number divides the crc32 of ``<doc_id>:<run>``; a
    row without doc_id loses none. Null and empty texts have no words; rows that repeat a
    doc_id all count. A task hands on its counts whenever it has met many different words,
    so neither long texts nor large vocabularies gather in it.
    """
    prepare(docs.sparkSession)
    counted = document_rows(docs).mapInArrow(_counted_rows(misspelt), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted_rows(misspelt: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
                found = _LETTERS.finditer(text.as_py().lower())
                salt = None if misspelt is None or doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                if salt is None:
                    counts.update(match[0] for match in found)
                else:
                    crc32 = zlib.crc32
                    for match in found:
                        word = match[0]
                        mark = crc32(word, salt)
                        counts[word if mark % misspelt else _shortened(word, mark)] += 1
                        if len(counts) > COUNTED:
                            yield _flushed(counts)
                if len(counts) > COUNTED:
                    yield _flushed(counts)
        yield _flushed(counts)

    return run


def _shortened(word: bytes, mark: int) -> bytes:
    letters = word.decode()
    at = mark % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _flushed(counts: Counter[bytes]) -> pa.RecordBatch:
    words, numbers = pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())
    counts.clear()
    return pa.RecordBatch.from_arrays([words, numbers], ["word", "n"])


def near_words(vocabulary: DataFrame, sample_words: int = SAMPLE_WORDS, leaf_words: int = LEAF_WORDS, block_words: int = BLOCK_WORDS, searchers: int = SEARCHERS) -> DataFrame:
    """(word, n_near, best): words with others one edit away, how many, and the most frequent.

    ``vocabulary`` holds distinct (word, n) of the letters of ``word_counts`` and is read
    more than once, so it should be stored. ``best`` is a struct (rank, word) that is
    smallest for the largest n, then the smallest word in code-point order; ``-rank`` is its n.

    How: words of one length are dealt by a k-d tree over their letter counts, fitted on a
    bounded sample, and every word is put into the leaf it lies in. One edit moves the counts by
    an L1 distance of two within a length, of one to the next length. A word searches the
    leaves of its own length and of the next whose boxes lie that near, within a leaf by a
    further tree, and the letters in order decide. Each pair meets once. Leaves with more
    words than a block, such as one of anagrams only, are dealt into blocks by hash, and many
    searchers of a block into several tasks. A task returns one row per word, not its pairs.
    """
    spark = vocabulary.sparkSession
    prepare(spark)
    rows = vocabulary.count()
    sample = [row["word"] for row in hashed_sample(vocabulary.select("word"), sample_words, rows, "word").collect()]
    sent = spark.sparkContext.broadcast(_trees(sample, leaf_words * len(sample) / max(1, rows)))
    routed = stored(vocabulary.mapInArrow(_routed_rows(sent), "word string, n bigint, length int, leaf bigint, home boolean, local boolean"), "routed-words")
    loads = routed.groupBy("length", "leaf").agg(
        F.greatest(F.ceil(F.count_if("home") / F.lit(block_words)), F.lit(1)).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.count_if(~F.col("home")) / F.lit(searchers)), F.lit(1)).cast("int").alias("parts"),
    )
    dealt = routed.join(loads, ["length", "leaf"])
    hashed = F.xxhash64("word")

    def each(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    # A word of the leaf lies in one of its blocks and takes part in all of its parts; a searcher the other way round.
    members = dealt.where("home").withColumn("block", F.pmod(hashed, F.col("blocks")).cast("int")).withColumn("part", each("parts"))
    guests = dealt.where("not home").withColumn("part", F.pmod(hashed, F.col("parts")).cast("int")).withColumn("block", each("blocks"))
    both = members.unionByName(guests).select("length", "leaf", "block", "part", "word", "n", "home", "local")
    met = both.groupBy("length", "leaf", "block", "part").applyInPandas(_near_rows, "word string, n_near bigint, rank bigint, near string")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("rank", F.col("near").alias("word"))).alias("best"))


def _trees(sample: list[str], leaf_points: float) -> dict[int, object]:
    """A tree for each length in the sample; a length that is not there is one leaf."""
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    return {length: partition(letter_counts(code_points(words, length), _ALPHABET), max(1, int(leaf_points)))[0] for length, words in by_length.items()}


def _routed_rows(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for batch in batches:
            words = np.array(batch.column("word").to_pylist(), object)
            counts = batch.column("n").to_numpy()
            lengths = np.array([len(word) for word in words], np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                vectors = letter_counts(code_points(list(words[at]), length), _ALPHABET)
                homes = home_leaves(trees.get(length, 0), vectors)
                yield _routed(words[at], counts[at], length, homes, True, np.ones(len(at), bool))
                who, leaf = leaves_within(trees.get(length, 0), vectors, 2)
                # Of two leaves of one length the words of the earlier search the later.
                later = leaf >= homes[who]
                yield _routed(words[at[who[later]]], counts[at[who[later]]], length, leaf[later], False, leaf[later] == homes[who[later]])
                who, leaf = leaves_within(trees.get(length + 1, 0), vectors, 1)
                yield _routed(words[at[who]], counts[at[who]], length + 1, leaf, False, np.zeros(len(who), bool))

    return run


def _routed(words: np.ndarray, counts: np.ndarray, length: int, leaves: np.ndarray, home: bool, local: np.ndarray) -> pa.RecordBatch:
    """Rows of a leaf's own words, or of searchers; ``local`` ones lie in that leaf themselves."""
    size = len(words)
    columns = [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(np.full(size, length, np.int32)), pa.array(leaves), pa.array(np.full(size, home)), pa.array(local)]
    return pa.RecordBatch.from_arrays(columns, ["word", "n", "length", "leaf", "home", "local"])


def _near_rows(rows: pd.DataFrame) -> pd.DataFrame:
    length = int(rows["length"].iloc[0])
    home = rows["home"].to_numpy(bool)
    own = rows[home]
    codes = code_points(list(own["word"]), length)
    vectors = letter_counts(codes, _ALPHABET)
    sides = []
    guests = rows[~home]
    sizes = guests["word"].str.len().to_numpy()
    for size in (length, length - 1):
        other = guests[sizes == size]
        if not len(other) or not len(own):
            continue
        theirs = code_points(list(other["word"]), size)
        who, point = pairs_within(vectors, letter_counts(theirs, _ALPHABET), 2 if size == length else 1)
        near = one_edit_apart(theirs[who], codes[point])
        a, b = other.iloc[who[near]], own.iloc[point[near]]
        a_word, b_word, a_n, b_n = (frame[name].to_numpy() for name in ("word", "n") for frame in (a, b))
        if size == length:
            # Words of one leaf meet in both orders: one of them is enough.
            once = ~a["local"].to_numpy(bool) | (a_word < b_word)
            a_word, b_word, a_n, b_n = a_word[once], b_word[once], a_n[once], b_n[once]
        sides += [(a_word, b_word, b_n), (b_word, a_word, a_n)]
    if not sides:
        return pd.DataFrame({"word": [], "n_near": [], "rank": [], "near": []}).astype({"word": str, "n_near": "int64", "rank": "int64", "near": str})
    word, near, n = (np.concatenate([side[k] for side in sides]) for k in range(3))
    pairs = pd.DataFrame({"word": word, "near": near, "rank": -n.astype(np.int64)}).sort_values(["word", "rank", "near"])
    grouped = pairs.groupby("word", sort=False)
    best = grouped.head(1).set_index("word")
    best["n_near"] = grouped.size()
    return best.reset_index()[["word", "n_near", "rank", "near"]]


def spelling_groups(vocabulary: DataFrame, times: int = TIMES, **sizes: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with the more frequent one it may stand for.

    ``form`` is the most frequent word one edit away, of equals the first in code-point order, if it
    occurs ``times`` times as often at least, else null; ``root`` is the end of the chain of
    forms, the word itself if it has none. Forms grow by a factor each, so chains are
    short, and they are followed by doubling. ``vocabulary`` is (word, n), distinct; an
    empty one gives no rows. ``sizes`` are those of ``near_words``.
    """
    near = near_words(vocabulary, **sizes)
    form_n = F.when(-F.col("best.rank") >= F.lit(times) * F.col("n"), -F.col("best.rank"))
    rows = stored(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), form_n.alias("form_n"), F.when(form_n.isNotNull(), F.col("best.word")).alias("form")
        ),
        "word-forms",
    )
    steps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        steps = stored(steps, "form-steps")
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("end"))
        ahead = steps.join(further, "root", "left")
        if ahead.where("end is not null").isEmpty():
            break
        steps = ahead.select("word", F.coalesce("end", "root").alias("root"))
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def frequent_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, misspelt: int | None = None) -> DataFrame:
    """The stored ``word_counts`` of words long and frequent enough."""
    counted = word_counts(docs, misspelt).where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    return stored(counted, "vocabulary")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(frequent_words(table(spark, sf_dir, "documents"), misspelt=MISSPELT))


# crc32 as a fold over its steps: a byte is mixed in, or (-1) one bit is shifted out.
SQL = """
with recursive runs as (
  select doc_id, r, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]+')) as r from documents)
  group by all
), marked as (
  select r, n, case when doc_id is not null then xor(list_reduce(list_prepend(4294967295::bigint, flatten(
      list_transform(string_split(doc_id || ':' || r, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]
        else [195::bigint, -1, -1, -1, -1, -1, -1, -1, -1, unicode(c)::bigint - 64, -1, -1, -1, -1, -1, -1, -1, -1] end))),
      lambda s, o: case when o >= 0 then xor(s, o) when s & 1 = 1 then xor(s >> 1, 3988292384) else s >> 1 end), 4294967295) else 1 end as h
  from runs
), words as (
  select case when h % 199 = 0 then left(r, (h % length(r))::int) || substr(r, (h % length(r))::int + 2) else r end as word, sum(n)::bigint as n
  from marked group by 1
), vocabulary as (
  select word, n from words where length(word) >= 6 and n >= 5
), shorter as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from vocabulary)
), pairs as (
  select distinct a.word as word, b.word as near, b.n as near_n from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from shorter a join vocabulary b on a.rest = b.word
  union select b.word, a.word, a.n from shorter a join vocabulary b on a.rest = b.word
), best as (
  select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pairs group by word
), forms as (
  select word, n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form, case when near_n >= 5 * n then near_n end as form_n
  from vocabulary left join best using (word)
), chains as (
  select word, word as root from forms
  union all
  select c.word, f.form from chains c join forms f on f.word = c.root where f.form is not null
)
select f.word, form, c.root, n, n_near, form_n
from forms f join (select c.word, c.root from chains c join forms e on e.word = c.root and e.form is null) c on c.word = f.word
"""
