"""Near-duplicate documents by SetSketch bands, a likelihood filter and exact sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import labelled, merged
from .setsketch import Shape, band_keys, can_reach, sketches
from .tables import document_rows, prepare, stored, table
from .words import SPACES, binary_array, distinct_by_text, mix, shingle_keys, text_chunks, words_of

# Fixed value: links need 100 * intersection >= PERCENT * union.
PERCENT = 80
# Classes of a bucket whose likely similarity with its smallest one is this belong to its family.
RELATED = 0.55
# Members of a chunk of a bucket, whose sketches are compared; rows of small buckets that
# one task call takes together.
BUCKET_CHUNK, TOGETHER = 2048, 4096
# Pairs with fewer equal registers than this part of the limit's are left to no likelihood:
# more than nine standard deviations below what a pair at the limit has.
EQUAL_PART = 0.75
# Members of a chunk of a family, and shingles that a membership matrix has columns for.
CHUNK = 512
# Ids are broadcast up to this size, at so many bytes each in memory.
ID_BYTES, BROADCAST_BYTES = 32, 64 << 20
COLUMNS = 8192
_SETS = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint"
_TEXT_KEY = "_text_key"


def near_duplicates(docs: DataFrame, shingle_words: int = 2, percent: int = PERCENT, shape: Shape = Shape()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) for every row of ``docs``.

    A document's set holds the distinct runs of ``shingle_words`` lower-cased words of its
    whole text; with fewer words, the one run of all of them. Two documents are linked if
    their sets overlap by ``percent``; ``component_id`` is the smallest doc_id reachable
    over links and ``kept`` marks the document of that id. ``text_key`` is a hash of the text.

    How: documents with equal sets form one class, and only a class's sketch goes on, so a
    hot group of copies is one row. Classes meet the smallest class of each bucket of their
    bands; the joint likelihood of two sketches tells which of them belong together as a
    family. Members of a bucket that are of different families then are compared with
    each other too, sketch by sketch in blocks of bounded size, so that an unrelated smallest
    class parts nobody. The full sets confirm a first link for each class. Only families
    that are not one component then are compared member by member, in blocks of bounded size, so
    that no link between their texts is lost; a block gives back the links that connect
    something, not its pairs. Nothing is capped. With the default shape a pair at the limit
    shares no bucket with probability 1e-8.

    A null or empty text, or one without words, has an empty set and is linked with
    nothing. A row without doc_id cannot be named: its component is null and it is kept.
    Rows that repeat a doc_id are judged each by its own text; of rows with the smallest
    doc_id of a component all are kept. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = document_rows(docs)
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    sets = stored(keyed.mapInArrow(_sketch_rows(shingle_words, shape), f"{_SETS}, registers binary, text_key bigint"), "sets")
    named = sets.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        named.groupBy("n_shingles", "d1", "d2")
        .agg(F.min_by(F.struct("doc_id", "registers"), "doc_id").alias("one"))
        .select(F.monotonically_increasing_id().alias("cls"), "n_shingles", "d1", "d2", "one.doc_id", "one.registers"),
        "classes",
    )
    labels = _links(rows, classes, shingle_words, percent, shape)
    # The smallest doc_id of each component, by way of the smallest of each class.
    of_class = stored(labelled(classes.drop("registers"), labels, "cls", "component"), "class-components")
    smallest = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named_classes = of_class.join(smallest, "component").select("n_shingles", "d1", "d2", "component_id")
    plain = sets.select("doc_id", "n_shingles", "d1", "d2", "text_key")
    joined = plain.join(named_classes, ["n_shingles", "d1", "d2"], "left")
    has_set = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(has_set, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "text_key",
    )


def _links(rows: DataFrame, classes: DataFrame, shingle_words: int, percent: int, shape: Shape) -> DataFrame | None:
    """(node, component) of the classes that confirmed links connect."""
    keys = classes.select("cls", "registers").mapInArrow(_band_rows(shape), "key bigint, cls bigint")
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("first")).where("n > 1")
    others = stored(keys.join(crowded, "key").where("cls <> first"), "bucket-members")
    met = others.select(F.col("first").alias("a"), F.col("cls").alias("b")).distinct()
    related = stored(_estimated(met, classes, percent, shape), "related")
    families = merged(None, related)
    further = stored(_bucket_links(others.where("n > 2").select("key", "cls"), families, classes, percent, shape), "further")
    families = merged(families, further)
    if families is None:
        return None
    sizes = classes.select("cls", "n_shingles", "d1", "d2", "doc_id")
    wanted = stored(sizes.join(families.select(F.col("node").alias("cls")).unionByName(families.select(F.col("component").alias("cls"))).distinct(), "cls"), "wanted")
    ids = wanted.select("doc_id").distinct()
    if wanted.count() * ID_BYTES <= BROADCAST_BYTES:
        # Few enough to be sent to the texts; else the texts are shuffled to them.
        ids = F.broadcast(ids)
    exact = stored(
        rows.join(ids, "doc_id", "left_semi")
        .mapInArrow(_set_rows(shingle_words), f"{_SETS}, shingles binary")
        .drop("doc_id")
        .join(wanted.drop("doc_id"), ["n_shingles", "d1", "d2"])
        .groupBy("cls").agg(F.first("shingles").alias("shingles")),
        "exact-sets",
    )
    # Each class is checked against the smallest one it seems linked with: most families
    # are one component then, and need no further look.
    credible = related.where("credible").select("a", "b").unionByName(further)
    chosen = credible.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    labels = merged(None, _confirmed(chosen, exact, percent))
    return merged(labels, _family_links(families, labels, exact, percent))


def _bucket_links(others: DataFrame, families: DataFrame | None, classes: DataFrame, percent: int, shape: Shape) -> DataFrame:
    """Credible links (a, b) between families that share a bucket, at most one per member and block.

    ``others`` are (key, cls) of the members that have met the smallest class of their
    bucket. Where all of them are of one family nothing is left to find.
    """
    members = labelled(others, families, "cls", "component").withColumnRenamed("key", "family")
    members = stored(_mixed(members), "rests")
    bins = max(1, members.count() // TOGETHER)
    registers = classes.select("cls", "n_shingles", "registers")
    rows = _in_blocks(members, BUCKET_CHUNK).join(registers, "cls")
    # Chunks that meet themselves, among them all small buckets, share calls.
    call = F.when(F.col("one") == F.col("two"), F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(F.col("family"))
    return rows.withColumn("call", call).groupBy("call", "one", "two").applyInPandas(_sketch_links(percent, shape), "a bigint, b bigint")


def _sketch_links(percent: int, shape: Shape):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        same = rows["one"].iloc[0] == rows["two"].iloc[0]
        rows = rows.sort_values(["family", "cls"])
        registers = np.frombuffer(b"".join(rows["registers"]), np.int16).reshape(len(rows), -1)
        sizes, cls = rows["n_shingles"].to_numpy(), rows["cls"].to_numpy()
        on_left = (rows["chunk"] == rows["one"]).to_numpy()
        names, component = np.unique(rows["component"].to_numpy(), return_inverse=True)
        bucket = rows["family"].to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        links = []
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            here = np.arange(begin, end)
            right = here if same else here[~on_left[here]]
            for i in here[on_left[here]].tolist():
                at = right[(right > i) & (component[right] != component[i])] if same else right[component[right] != component[i]]
                at = at[(registers[at] == registers[i]).sum(axis=1) >= EQUAL_PART * percent / 100 * shape.registers]
                if not len(at):
                    continue
                own = np.broadcast_to(registers[i], (len(at), registers.shape[1]))
                good = can_reach(own, registers[at], np.full(len(at), sizes[i]), sizes[at], percent / 100, shape.base)
                for j in at[good].tolist():
                    if component[j] != component[i]:
                        component[component == component[j]] = component[i]
                        links.append((min(int(cls[i]), int(cls[j])), max(int(cls[i]), int(cls[j]))))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _family_links(families: DataFrame, labels: DataFrame | None, exact: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside families that are not one component, at most one per member and block.

    A family is dealt by hash into chunks of about ``CHUNK`` members, large components apart
    from the rest. Every two chunks that hold different components meet in a task of their
    own, where their sets are compared exactly by products of membership matrices.
    """
    nodes = families.select("component", F.col("node").alias("cls")).unionByName(families.select("component", F.col("component").alias("cls")).distinct())
    members = labelled(nodes.withColumnRenamed("component", "family"), labels, "cls", "component")
    members = stored(_mixed(members), "family-members")
    rows = _in_blocks(members, CHUNK).join(exact, "cls").select("family", "one", "two", "chunk", "cls", "component", "shingles")
    return rows.groupBy("family", "one", "two").applyInPandas(_block_links(percent), "a bigint, b bigint")


def _mixed(members: DataFrame) -> DataFrame:
    """The (family, cls, component) rows of families with more than one component."""
    mixed = members.groupBy("family").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("family")
    return members.join(mixed, "family", "left_semi")


def _in_blocks(members: DataFrame, size: int) -> DataFrame:
    """(family, one, two, chunk, cls, component): members once for each block they take part in."""
    # A component that fills chunks has its own; the smaller ones of a family share theirs.
    pool = F.when(F.col("n") >= size, F.col("component")).otherwise(F.lit(-1).cast("bigint")).alias("pool")
    pools = members.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n")).select("family", "component", pool, "n")
    chunks = pools.groupBy("family", "pool").agg(F.ceil(F.sum("n") / F.lit(size)).cast("int").alias("chunks"))
    numbered = pools.drop("n").join(chunks, ["family", "pool"])
    placed = members.join(numbered, ["family", "component"]).select(
        "family", "cls", "component", _chunk("pool", F.pmod(F.xxhash64("cls"), "chunks")).alias("chunk")
    )
    every = chunks.select("family", "pool", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("k"))
    every = stored(every.select("family", "pool", _chunk("pool", F.col("k")).alias("chunk")), "chunks")
    one = every.select("family", F.col("chunk").alias("one"), F.col("pool").alias("pool_1"))
    two = every.select("family", F.col("chunk").alias("two"), F.col("pool").alias("pool_2"))
    # Chunks of one and the same component have nothing to find.
    blocks = one.join(two, "family").where("one <= two and (pool_1 <> pool_2 or pool_1 = -1)").select("family", "one", "two")
    uses = blocks.select("family", "one", "two", F.col("one").alias("chunk")).unionByName(
        blocks.where("one <> two").select("family", "one", "two", F.col("two").alias("chunk"))
    )
    return placed.join(uses, ["family", "chunk"]).select("family", "one", "two", "chunk", "cls", "component")


def _chunk(pool: str, number: Column) -> Column:
    return F.concat_ws(":", F.col(pool), number)


def _block_links(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows["one"].iloc[0]
        left = rows[rows["chunk"] == first].sort_values("cls")
        right = left if rows["two"].iloc[0] == first else rows[rows["chunk"] != first].sort_values("cls")
        root: dict[int, int] = {}

        def end(node: int) -> int:
            while root.get(node, node) != node:
                root[node] = root.get(root[node], root[node])
                node = root[node]
            return node

        linked = _linked_pairs(list(left["shingles"]), list(right["shingles"]), percent)
        links = []
        for i, j in zip(*linked, strict=True):
            sides = end(int(left["component"].iloc[i])), end(int(right["component"].iloc[j]))
            if sides[0] != sides[1]:
                root[max(sides)] = min(sides)
                links.append((int(left["cls"].iloc[i]), int(right["cls"].iloc[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _linked_pairs(left: list[bytes], right: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs whose sets overlap enough, by exact counts of what they share."""
    sides = [[np.frombuffer(own, np.uint64) for own in side] for side in (left, right)]
    elements, column = np.unique(np.concatenate([*sides[0], *sides[1]]), return_inverse=True)
    sizes = [np.array([len(own) for own in side]) for side in sides]
    owner = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(elements), COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        # Counts below 2**24 are exact in single precision.
        held = np.zeros((len(left) + len(right), min(COLUMNS, len(elements) - begin)), np.float32)
        held[owner[a:b], column[a:b] - begin] = 1
        shared += held[: len(left)] @ held[len(left) :].T
    both = shared.astype(np.int64)
    return np.nonzero(100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both))


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int, shape: Shape) -> DataFrame:
    """Pairs whose likely similarity is RELATED at least; ``credible`` if the limit is possible too."""
    for side in ("a", "b"):
        one = classes.select(F.col("cls").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}"))
        pairs = pairs.join(one, side)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [_matrix(batch.column(f"r_{side}"), np.int16) for side in ("a", "b")]
            sizes = [batch.column(f"n_{side}").to_numpy() for side in ("a", "b")]
            credible = can_reach(*sides, *sizes, percent / 100, shape.base)
            good = pa.array(credible | can_reach(*sides, *sizes, RELATED, shape.base, 0.0))
            chosen = batch.select(["a", "b"])
            yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(credible)], ["a", "b", "credible"]).filter(good)

    return pairs.mapInArrow(keep, "a bigint, b bigint, credible boolean")


def _confirmed(pairs: DataFrame, exact: DataFrame, percent: int) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(exact.select(F.col("cls").alias(side), F.col("shingles").alias(f"s_{side}")), side)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                _overlap(a.as_buffer(), b.as_buffer(), percent) for a, b in zip(batch.column("s_a"), batch.column("s_b"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(keep, "a bigint, b bigint")


def _overlap(a: pa.Buffer, b: pa.Buffer, percent: int) -> bool:
    both = np.concatenate((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    if not len(column):
        return np.empty((0, 1), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _text_sets(batch: pa.RecordBatch, shingle_words: int):
    """(number of the first text, doc_ids, sorted distinct shingles, offsets, digests) per run of texts."""
    for first, data, offsets in text_chunks(batch.column("text")):
        texts = len(offsets) - 1
        doc, keys = shingle_keys(words_of(data, offsets, SPACES), shingle_words)
        shingles, ends = distinct_by_text(doc, keys, texts)
        # Two independent sums over the elements name a set.
        digests = []
        for salt in (0x1234567, 0x89ABCDEF01):
            sums = np.zeros(len(shingles) + 1, np.uint64)
            np.cumsum(mix(shingles ^ np.uint64(salt)), out=sums[1:])
            digests.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
        yield first, batch.column("doc_id").slice(first, texts), shingles, ends, digests


def _sketch_rows(shingle_words: int, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, shingles, ends, digests in _text_sets(batch, shingle_words):
                counts = np.diff(ends)
                registers = sketches(shingles, counts, shape)
                packed = binary_array(registers.reshape(-1), np.full(len(counts), shape.registers))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts), *map(pa.array, digests), packed, batch.column("text_key").slice(first, len(counts))],
                    ["doc_id", "n_shingles", "d1", "d2", "registers", "text_key"],
                )

    return run


def _set_rows(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, shingles, ends, digests in _text_sets(batch, shingle_words):
                counts = np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts), *map(pa.array, digests), binary_array(shingles, counts)],
                    ["doc_id", "n_shingles", "d1", "d2", "shingles"],
                )

    return run


def _band_rows(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch.column("registers"), np.int16), shape) if batch.num_rows else np.empty((0, 1), np.uint64)
            classes = np.repeat(batch.column("cls").to_numpy(), shape.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(classes)], ["key", "cls"])

    return run


def deduplicated(docs: DataFrame, shingle_words: int, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near copies, that of the smallest doc_id.

    Rows without a doc_id stay, as do documents without words. Of rows that repeat both the
    doc_id and the text one stays; rows that repeat only the doc_id are told apart by text.
    """
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    named = docs.where(F.col("doc_id").isNotNull()).withColumn(_TEXT_KEY, key)
    kept = near_duplicates(docs, shingle_words, percent).where("kept and doc_id is not null")
    stay = kept.select("doc_id", F.col("text_key").alias(_TEXT_KEY)).distinct()
    one = named.join(stay, ["doc_id", _TEXT_KEY], "left_semi").dropDuplicates(["doc_id", _TEXT_KEY])
    return one.drop(_TEXT_KEY).unionByName(docs.where(F.col("doc_id").isNull()))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), edges as (
  select a, b from links union all select b, a from links
), reached as (
  select doc_id as node, doc_id as other from documents
  union
  select node, b from reached join edges on other = a
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from (select node as doc_id, min(other) as component_id from reached group by node) left join sizes using (doc_id)
"""
