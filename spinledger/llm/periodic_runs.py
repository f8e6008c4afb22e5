"""Periodic runs of words: stretches that repeat themselves at least four times."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .segments import PIECE, pieces
from .tables import document_rows, prepare, stored, table
from .tiles import agreements, borders, joined, word_keys
from .words import mix, text_chunks

# Fixed values of the contract: a run's words at least, and how often its period fits.
MIN_WORDS, REPEATS = 6, 4
# Tiles of texts of more characters are shuffled, so that one text is solved by many tasks.
LONG_CHARS = 4 << 20
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, long_chars: int = LONG_CHARS) -> DataFrame:
    """(doc_id, runs, collapsed_sha256) for every row of ``docs``.

    Words are what white space (blank, tab to carriage return) parts, case and all, numbered from 0. A run is a stretch
    of consecutive words with smallest period q and at least ``max(6, 4q)`` words that no
    neighbouring word extends keeping that period. ``runs`` are (start, length, period) by start,
    then period; ``collapsed_sha256`` is of the words, joined by one blank, without
    those that some run contains after its first q words.

    How: a text's words are cut into tiles that overlap, by octave of the period, around the
    borders where words agree with a shift of themselves; a tile is solved by itself with two
    Z-functions. What it finds are fragments of runs, which are shuffled by document and period and
    stitched where they touch. Of stretches with equal bounds the one with the smallest
    period is the run. Texts without any border that qualifies, nearly all, are done in the first
    pass; only the others are stored. Tiles of very long texts are dealt to all tasks.

    A null or empty text, or one without words, has no runs and an empty text's digest. Rows
    without doc_id or with a repeated one are judged each by its own text. Other columns are
    ignored. An empty table gives no rows. Very long texts are read in pieces; eight bytes a word
    are held, and a tile is shorter than a text.
    """
    prepare(docs.sparkSession)
    first = stored(
        document_rows(docs)
        .withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(_first_look, "row bigint, doc_id bigint, text string, plain string"),
        "texts-with-repeats",
    )
    texts = first.where("text is not null").select("row", "text")
    is_long = F.length("text") > long_chars
    tile = "row bigint, s bigint, border bigint, before bigint, size bigint, words binary"
    near = texts.where(~is_long).mapInArrow(_tile_rows, tile).mapInArrow(_solve, _FRAGMENT)
    dealt = texts.where(is_long).mapInArrow(_tile_rows, tile).repartition(F.col("row"), F.col("s"), F.col("border"))
    fragments = near.unionByName(dealt.mapInArrow(_solve, _FRAGMENT))
    by_row = stored(_runs(fragments), "periodic-runs")
    # By shuffle at any size: the few texts with repeats are far larger than their runs.
    repeats = first.where("text is not null").join(by_row.hint("merge"), "row", "left").select("doc_id", "text", F.coalesce("runs", _no_runs()).alias("runs"))
    collapsed = repeats.mapInArrow(_collapsed_rows, f"doc_id bigint, runs {_RUNS}, collapsed_sha256 string")
    plain = first.where("text is null").select("doc_id", _no_runs().alias("runs"), F.col("plain").alias("collapsed_sha256"))
    return plain.unionByName(collapsed)


def _no_runs() -> Column:
    return F.array().cast(_RUNS)


_FRAGMENT = "row bigint, period bigint, lo bigint, hi bigint"


def _runs(fragments: DataFrame) -> DataFrame:
    """(row, runs): fragments of one document and period stitched, long enough, of smallest period."""
    ordered = Window.partitionBy("row", "period").orderBy("lo", "hi")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("lo") > F.max("hi").over(earlier), F.lit(True))
    numbered = fragments.withColumn("fresh", fresh.cast("int")).withColumn("stretch", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = numbered.groupBy("row", "period", "stretch").agg(F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("period")).alias("length"))
    enough = stretches.where(F.col("length") >= F.greatest(F.lit(MIN_WORDS), REPEATS * F.col("period")))
    smallest = enough.groupBy("row", "start", "length").agg(F.min("period").alias("period"))
    return smallest.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("by_length")).select(
        "row", F.array_sort("by_length", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)).alias("runs")
    )


def _documents(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first text, first word of each text and the end, keys apart by text, longest period)."""
    for first, data, offsets in text_chunks(texts):
        doc, keys = word_keys(data, offsets, PIECE)
        ends = np.searchsorted(doc, np.arange(len(offsets)))
        if len(offsets) > 2:
            # Words of different texts never agree.
            keys = mix(keys + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield first, ends, keys, int(np.diff(ends).max(initial=0)) // REPEATS


def _first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, chosen = batch.column("text"), np.zeros(batch.num_rows, bool)
        for first, ends, keys, longest in _documents(texts):
            for _, found in borders(keys, longest):
                chosen[first + np.searchsorted(ends, found, side="right") - 1] = True
        plain = [None if chosen[k] else _digest(text.as_py()) for k, text in enumerate(texts.cast(pa.large_binary()))]
        kept = pc.if_else(pa.array(chosen), texts, pa.scalar(None, texts.type))
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), kept.cast(pa.string()), pa.array(plain, pa.string())], ["row", "doc_id", "text", "plain"])


def _digest(text: bytes, dropped: list[tuple[int, int]] | None = None) -> str:
    """The digest of the words joined by one blank, without those in the sorted, separate ``dropped`` spans."""
    digest, number, blank, spans = hashlib.sha256(), 0, b"", list(dropped or [])
    for piece in pieces(text):
        words = piece.split()
        keep = np.ones(len(words), bool)
        while spans and spans[0][0] < number + len(words):
            begin, end = spans[0]
            keep[max(begin - number, 0) : end - number] = False
            if end > number + len(words):
                break
            spans.pop(0)
        number += len(words)
        left = [word for word, own in zip(words, keep, strict=True) if own] if not keep.all() else words
        if left:
            digest.update(blank + b" ".join(left))
            blank = b" "
    return digest.hexdigest()


def _tile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("row").to_numpy()
        for first, ends, keys, longest in _documents(batch.column("text")):
            ids = np.unique(keys, return_inverse=True)[1].astype("<i4")
            for s, found in borders(keys, longest):
                doc = np.searchsorted(ends, found, side="right") - 1
                begin, end = np.maximum(found - s, ends[doc]), np.minimum(found + 3 * s, ends[doc + 1])
                for part in range(0, len(found), 1 << 16):
                    some = slice(part, part + (1 << 16))
                    own = doc[some]
                    words = [ids[a:b].tobytes() for a, b in zip(begin[some].tolist(), end[some].tolist(), strict=True)]
                    columns = [
                        pa.array(rows[first + own]), pa.array(np.full(len(own), s)), pa.array(found[some] - ends[own]),
                        pa.array(found[some] - begin[some]), pa.array(ends[own + 1] - ends[own]), pa.array(words, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "s", "border", "before", "size", "words"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("row", "s", "border", "before"))
        found = []
        for row, s, border, before, words in zip(*columns, batch.column("words"), strict=True):
            tile = np.frombuffer(words.as_buffer(), "<i4").tolist()
            found += [(row, period, border + start, border + end) for period, start, end in agreements(tile, before, s)]
        # Fragments of neighbouring tiles are joined here already.
        whole = joined(np.array(found, np.int64).reshape(-1, 4))
        yield pa.RecordBatch.from_arrays([pa.array(whole[:, k]) for k in range(4)], ["row", "period", "lo", "hi"])


def _collapsed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for text, runs in zip(batch.column("text").cast(pa.large_binary()), batch.column("runs"), strict=True):
            spans = np.array([(0, 0, run["start"] + run["period"], run["start"] + run["length"]) for run in runs.as_py()], np.int64).reshape(-1, 4)
            digests.append(_digest(text.as_py(), [(int(a), int(b)) for _, _, a, b in joined(spans)]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("runs"), pa.array(digests, pa.string())], ["doc_id", "runs", "collapsed_sha256"])


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth document, by the crc32 of its id, ends in a repeat of its own words.

    With h = crc32(doc_id) and g = h // 10, if h % 10 = 0 the words from a = g % n on become repeats of
    the first 1 + (n - a) // (3 + g % 8) of them. Other texts are left as they are.
    """
    rows = document_rows(docs)
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce((h % 10) == 0, F.lit(False)) & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    words = rows.where(chosen).withColumn("words", F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1)))
    g, n = F.floor(h / 10), F.size("words")
    placed = words.withColumn("a", (g % n).cast("int")).withColumn("n", n)
    placed = placed.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (3 + g % 8)) + 1).cast("int"))
    rest = F.col("n") - F.col("a")
    times = F.ceil(rest / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.where(~chosen).unionByName(placed.select("doc_id", text.alias("text")))


def _best() -> Column:
    """The run of largest length by period; of equal ones the first by start, then period."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate("runs", none, better)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents"))).withColumn("best", _best())
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


# A stretch of a period is found by runs of equal five-word shingles a period apart: every run
# of the contract agrees with its shift over five words at least.
SQL = """
with texts as (
  select doc_id, regexp_extract_all(coalesce("text", ''), '[^\\x20\\x09-\\x0D]+') as w,
    case when doc_id is not null then xor(list_reduce(list_prepend(4294967295::bigint, flatten(
      list_transform(string_split(doc_id::varchar, ''), lambda c: [unicode(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, o: case when o >= 0 then xor(s, o) when s & 1 = 1 then xor(s >> 1, 3988292384) else s >> 1 end), 4294967295) else 1 end as h
  from documents
), planted as (
  select doc_id, case when h % 10 = 0 and len(w) > 0 then list_transform(range(0, len(w)), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end as w
  from (select *, 1 + (len(w) - a) // (3 + (h // 10) % 8) as p from (select *, case when len(w) > 0 then (h // 10) % len(w) end as a from texts))
), shingles as (
  select doc_id, i, hash(w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5]) as s, len(w) as n
  from (select doc_id, w, unnest(range(0, len(w) - 4)) as i from planted)
), agreeing as (
  select a.doc_id, a.i, b.i - a.i as q from shingles a join shingles b on a.doc_id = b.doc_id and a.s = b.s and b.i > a.i and 4 * (b.i - a.i) <= a.n
), stretches as (
  select doc_id, q, min(i) as start, count(*) + 4 + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as g from agreeing) group by doc_id, q, g
), runs as (
  select doc_id, start, length, min(q) as period from stretches where length >= greatest(6, 4 * q) group by doc_id, start, length
), lists as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as text from runs group by doc_id
), best as (
  select a.* from runs a where not exists (select 1 from runs b where b.doc_id = a.doc_id
    and (b.length * a.period, -b.start, -b.period) > (a.length * b.period, -a.start, -a.period))
), dropped as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs
), kept as (
  select p.doc_id, string_agg(p.word, ' ' order by p.i) as text
  from (select doc_id, unnest(range(0, len(w))) as i, unnest(w) as word from planted) p anti join dropped d on d.doc_id = p.doc_id and d.i = p.i group by p.doc_id
)
select t.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
  sha256(coalesce(l.text, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from texts t left join lists l on l.doc_id = t.doc_id left join best b on b.doc_id = t.doc_id left join kept k on k.doc_id = t.doc_id
"""
