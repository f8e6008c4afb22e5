"""Nearest vectors by multiprobe p-stable hashing and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from math import erf
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import hashed_sample, prepare, stored, table

# Fixed values of the contract.
QUERY_EVERY = 20
NEIGHBOURS = 20
# Hash tables, projections of each, width of a bin in units of a projection's spread.
TABLES, PROJECTIONS, WIDTH = 2, 6, 1.5
# Bins beyond the outermost count as it: with these a table has 7**6 buckets at most, which
# bounds the directory of buckets that every task holds.
OUTER_BIN = 3
# The plan is fitted on so many vectors, some of which are the queries.
FIT_VECTORS, FIT_QUERIES = 4096, 192
TARGET_RECALL = 0.95
# Vectors and queries of a block, which one task compares: as many as fit well into memory,
# since each block gives back its best for every query that visits it. Queries are taken
# so many at once.
BLOCK_ROWS = 16384
QUERIES_AT_ONCE = 64

_NORMAL_GRID = np.linspace(-9, 9, 2001)
_NORMAL = np.array([0.5 * (1 + erf(x / 2**0.5)) for x in _NORMAL_GRID])


class Hashes(NamedTuple):
    """Random projections, and what is known of the data they are applied to."""

    directions: np.ndarray  # TABLES x PROJECTIONS x (dimension + 1)
    shifts: np.ndarray  # TABLES x PROJECTIONS
    width: float
    longest: float  # largest norm of all vectors
    cosine: float  # of a query and a typical near vector
    share: float  # of the rows that a query visits in each table


def draw_hashes(dimension: int, longest: float, seed: int = 3) -> Hashes:
    rng = np.random.default_rng(seed)
    width = WIDTH * longest
    return Hashes(
        rng.normal(size=(TABLES, PROJECTIONS, dimension + 1)), rng.uniform(0, width, (TABLES, PROJECTIONS)), width, longest, 0.5, 1.0
    )


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more component gives all vectors the same norm: the largest inner product with a
    query is then the smallest distance from it, which is what the hashes are made for."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0.0))
    return np.concatenate((vectors, rest[:, None]), axis=1)


def lifted_queries(queries: np.ndarray, longest: float) -> np.ndarray:
    scaled = queries * (longest / np.linalg.norm(queries, axis=1))[:, None]
    return np.concatenate((scaled, np.zeros((len(queries), 1))), axis=1)


def buckets(hashes: Hashes, points: np.ndarray, number: int) -> np.ndarray:
    """The bucket of each lifted vector in one table: its bins as digits of a number."""
    bins = np.floor((points @ hashes.directions[number].T + hashes.shifts[number]) / hashes.width)
    bins = np.clip(bins, -OUTER_BIN, OUTER_BIN).astype(np.int64) + OUTER_BIN
    return bins @ (2 * OUTER_BIN + 1) ** np.arange(PROJECTIONS)


def visiting_order(hashes: Hashes, queries: np.ndarray, number: int, held: np.ndarray, counts: np.ndarray, least: int):
    """(queries x buckets) which of the ``held`` buckets each lifted query visits.

    A near vector's projection is normal around the query's, shrunk by the typical cosine.
    The chance that all its bins are those of a bucket, for each row the bucket holds, puts
    the buckets in order; they are visited until the wanted share of rows is reached.
    """
    base = 2 * OUTER_BIN + 1
    places = queries @ hashes.directions[number].T
    spread = hashes.longest * np.sqrt(max(1.0 - hashes.cosine**2, 1e-6))
    edges = np.arange(-OUTER_BIN, OUTER_BIN + 2) * hashes.width
    chance = np.zeros((len(queries), len(held)), np.float32)
    for k in range(PROJECTIONS):
        z = (edges[None, :] - hashes.shifts[number, k] - hashes.cosine * places[:, k : k + 1]) / spread
        below = np.interp(z, _NORMAL_GRID, _NORMAL)
        below[:, 0], below[:, -1] = 0.0, 1.0
        logs = np.log(np.maximum(np.diff(below, axis=1), 1e-12)).astype(np.float32)
        chance += logs[:, held // base**k % base]
    order = np.argsort(np.log(counts).astype(np.float32) - chance, axis=1, kind="stable")
    before = np.cumsum(counts[order], axis=1) - counts[order]
    wanted = max(hashes.share * counts.sum(), least)
    visited = np.zeros(chance.shape, bool)
    np.put_along_axis(visited, order, before < wanted, axis=1)
    return visited


def fitted(hashes: Hashes, sample: np.ndarray, neighbours: int) -> Hashes:
    """The typical cosine and the smallest share of rows that reach the target recall.

    Neighbours within a sample are farther away than those among all rows, so that what is
    enough for the sample is enough for all.
    """
    if len(sample) <= 4 * neighbours:
        return hashes._replace(share=1.0)
    points = lifted(sample, hashes.longest)
    asked = sample[np.linspace(0, len(sample) - 1, FIT_QUERIES).astype(int)]
    queries = lifted_queries(asked, hashes.longest)
    cosines = queries @ points.T / hashes.longest**2
    # The first is the query itself.
    nearest = np.argsort(-cosines, axis=1)[:, 1 : neighbours + 1]
    hashes = hashes._replace(cosine=float(np.clip(np.take_along_axis(cosines, nearest, 1).mean(), 0.05, 0.98)))
    own = [buckets(hashes, points, number) for number in range(TABLES)]
    for share in (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9):
        tried = hashes._replace(share=share)
        met = np.zeros((len(queries), len(sample)), bool)
        for number in range(TABLES):
            held, inverse, counts = np.unique(own[number], return_inverse=True, return_counts=True)
            met |= visiting_order(tried, queries, number, held, counts, neighbours + 1)[:, inverse]
        if np.take_along_axis(met, nearest, 1).mean() >= TARGET_RECALL:
            return tried
    return hashes._replace(share=1.0)


def _usable(vector: str) -> Column:
    """Not null, not all zero, every component a finite number."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return value.isNotNull() & (F.size(value) > 0) & finite & F.exists(value, lambda x: x != 0)


def nearest_vectors(rows: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each query, nearest first.

    Both frames come as (vec_id, embedding); a query's own row, or any of the same vec_id,
    is no candidate. Score is the inner product in double precision; ties go to the smaller
    vec_id. A query with at most ``neighbours`` candidates gets all of them.

    Vectors that are null, zero or hold a null or non-finite component take no part, nor do
    those without vec_id or of another length than most. Rows that repeat a vec_id with the
    same vector count once; with different vectors the best one counts. Other columns are
    ignored, and an empty table gives no rows.

    Of equal vectors only ``neighbours + 1`` can be in any result, those with the smallest
    ids, so only they are indexed and a vector that fills a third of the table is no hot
    bucket. Rows and queries meet in blocks of bounded size: a block holds part of the
    buckets of a table, a large one is dealt to several, and its task keeps the best of each
    query before anything is shuffled on.
    """
    spark = rows.sparkSession
    prepare(spark)
    data = _named(rows)
    dimension = data.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dimension is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    same_length = F.size("embedding") == dimension["d"]
    data = data.where(same_length)
    asked = _named(queries).where(same_length).distinct()
    few = Window.partitionBy("embedding").orderBy("vec_id")
    index_rows = stored(
        data.distinct().withColumn("copy", F.row_number().over(few)).where(F.col("copy") <= neighbours + 1).drop("copy"), "vectors"
    )
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    measured = index_rows.agg(F.max(norm), F.count(F.lit(1))).first()
    longest = float(measured[0])
    hashes = draw_hashes(dimension["d"], longest * (1 + 1e-9))
    sample = hashed_sample(index_rows, FIT_VECTORS, measured[1], "vec_id", "embedding").collect()
    hashes = fitted(hashes, np.array([row["embedding"] for row in sample], float), neighbours)

    sent = spark.sparkContext.broadcast(hashes)
    placed = stored(index_rows.mapInArrow(_bucket_rows(sent), "number int, bucket bigint, vec_id bigint, embedding array<double>"), "buckets")
    # At most TABLES * 7 ** PROJECTIONS entries, whatever the number of rows.
    directory = placed.groupBy("number", "bucket").count().collect()
    held = [
        tuple(np.array(sorted((r["bucket"], r["count"]) for r in directory if r["number"] == n), np.int64).T) for n in range(TABLES)
    ]
    blocks = max(1, -(-sum(int(counts.sum()) for _, counts in held) // (TABLES * BLOCK_ROWS)))
    slices = max(1, -(-asked.count() // BLOCK_ROWS))
    of_block = np.zeros((TABLES, blocks), np.int64)
    for number, (own, counts) in enumerate(held):
        np.add.at(of_block[number], _block_of(own, blocks), counts)
    # A block with many rows is dealt to several tasks.
    parts = -(-of_block // BLOCK_ROWS)
    plan = spark.sparkContext.broadcast((hashes, held, blocks, parts, slices, neighbours))

    keys = ["number", "block", "part", "slice"]
    key_types = "number int, block int, part int, slice int"
    probes = asked.mapInArrow(_probe_rows(plan), f"{key_types}, query_id bigint, embedding array<double>, visited array<bigint>")
    dealt = placed.mapInArrow(_dealt_rows(plan), f"{key_types}, bucket bigint, vec_id bigint, embedding array<double>")
    compared = (
        probes.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(_best_of_block(neighbours), "query_id bigint, vec_id bigint, score double")
    )
    best = compared.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def _named(rows: DataFrame) -> DataFrame:
    embedding = F.col("embedding").cast("array<double>").alias("embedding")
    return rows.where(F.col("vec_id").isNotNull() & _usable("embedding")).select(F.col("vec_id").cast("bigint").alias("vec_id"), embedding)


def _block_of(bucket: np.ndarray, blocks: int) -> np.ndarray:
    return (bucket * 2654435761 >> 7) % blocks


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), -1)


def _bucket_rows(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = lifted(_matrix(batch.column("embedding")), hashes.longest)
            for number in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(points), number, np.int32)), pa.array(buckets(hashes, points, number)), batch.column("vec_id"), batch.column("embedding")],
                    ["number", "bucket", "vec_id", "embedding"],
                )

    return run


def _dealt_rows(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, blocks, parts, slices, _ = plan.value
        for batch in batches:
            number = batch.column("number").to_numpy()
            block = _block_of(batch.column("bucket").to_numpy(), blocks)
            part = batch.column("vec_id").to_numpy() % np.maximum(parts[number, block], 1)
            for one in range(slices):
                keys = [pa.array(values.astype(np.int32)) for values in (number, block, part, np.full(len(block), one))]
                yield pa.RecordBatch.from_arrays(
                    [*keys, batch.column("bucket"), batch.column("vec_id"), batch.column("embedding")],
                    ["number", "block", "part", "slice", "bucket", "vec_id", "embedding"],
                )

    return run


def _probe_rows(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, blocks, parts, slices, neighbours = plan.value
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                some = batch.slice(first, 128)
                points = lifted_queries(_matrix(some.column("embedding")), hashes.longest)
                rows: list[tuple] = []
                for number in range(TABLES):
                    own, counts = held[number]
                    visited = visiting_order(hashes, points, number, own, counts, neighbours + 1)
                    block = _block_of(own, blocks)
                    for query in range(some.num_rows):
                        at = np.flatnonzero(visited[query])
                        at = at[np.argsort(block[at], kind="stable")]
                        edges = np.flatnonzero(np.diff(block[at], prepend=-1))
                        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)], strict=True):
                            own_block = int(block[at[a]])
                            for part in range(int(parts[number, own_block])):
                                rows.append((number, own_block, part, query, own[at[a:b]]))
                query = np.array([row[3] for row in rows], np.int64)
                ids = some.column("vec_id").to_numpy()[query]
                keys = [pa.array(np.array([row[k] for row in rows], np.int32)) for k in range(3)]
                slice_ = pa.array(((ids // QUERY_EVERY) % slices).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*keys, slice_, pa.array(ids), some.column("embedding").take(pa.array(query)), pa.array([row[4] for row in rows], pa.list_(pa.int64()))],
                    ["number", "block", "part", "slice", "query_id", "embedding", "visited"],
                )

    return run


def _best_of_block(neighbours: int):
    def run(probes: pd.DataFrame, dealt: pd.DataFrame) -> pd.DataFrame:
        if not len(probes) or not len(dealt):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        dealt = dealt.sort_values("vec_id")
        held, inverse = np.unique(dealt["bucket"].to_numpy(), return_inverse=True)
        ids = dealt["vec_id"].to_numpy()
        vectors = np.stack(dealt["embedding"].to_list())
        out = []
        for first in range(0, len(probes), QUERIES_AT_ONCE):
            some = probes.iloc[first : first + QUERIES_AT_ONCE]
            queries = some["query_id"].to_numpy()
            scores = np.stack(some["embedding"].to_list()) @ vectors.T
            open_ = np.zeros((len(some), len(held)), bool)
            for row, visited in enumerate(some["visited"]):
                open_[row, np.searchsorted(held, np.intersect1d(visited, held, assume_unique=True))] = True
            scores[~open_[:, inverse] | (queries[:, None] == ids[None, :])] = -np.inf
            if scores.shape[1] > neighbours:
                limit = np.partition(scores, -neighbours, axis=1)[:, -neighbours]
            else:
                limit = np.full(len(some), -np.inf)
            row, column = np.nonzero((scores >= limit[:, None]) & (scores > -np.inf))
            value = scores[row, column]
            order = np.lexsort((ids[column], -value, row))
            row, column, value = row[order], column[order], value[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            kept = place < neighbours
            out.append(pd.DataFrame({"query_id": queries[row[kept]], "vec_id": ids[column[kept]], "score": value[kept]}))
        return pd.concat(out)

    return run


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest_vectors(rows, rows.where(F.col("vec_id") % QUERY_EVERY == 0))
