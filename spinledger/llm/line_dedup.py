"""Lines found in many documents, counted exactly, filtered by cuckoo filters, reversible."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.paths import read_note, write_note
from .cuckoo import CuckooFilter
from .tables import carried, extended, prepare, restored, table

# Fixed values of the contract.
MIN_DOCUMENTS = 10
MIN_CHARS = 1
SHARDS = 64
# Filters go to every executor only below this size; beyond it lines meet the counts by join.
FILTER_LIMIT_BYTES = 64 << 20

_COUNTS = "shard int, key binary, n bigint"


def line_key(line: bytes) -> bytes:
    """Blanks stripped at both ends, A-Z in lower case; both are ASCII-only on bytes."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def _key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _short(key: bytes, min_chars: int) -> bool:
    return len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars)


class LineIndex:
    """In how many documents each line stands, kept as versions below ``path``.

    ``counts`` is the exact table (shard, key, n), ``filters`` one cuckoo filter per shard
    with the keys of at least ``min_documents`` documents. ``insert`` and ``delete`` write
    the next version: counts by a grouped sum, filters by inserting keys that cross the
    limit upwards and deleting those that cross it downwards. A version is named, by a rename,
    only after both its tables are written, so a lost executor or driver leaves the last one
    intact, and an index that is opened again on its path goes on from there.
    """

    def __init__(self, spark: SparkSession, path: str, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, shards: int = SHARDS):
        self.spark, self.path, self.version = spark, path, read_note(spark, f"{path}/version") or 0
        self.min_documents, self.min_chars, self.shards = min_documents, min_chars, shards

    def counts(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(f"{self.path}/counts-{self.version}")

    def filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], "shard int, cells binary")
        return self.spark.read.schema("shard int, cells binary").parquet(f"{self.path}/filters-{self.version}")

    def insert(self, docs: DataFrame) -> None:
        self._update(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take documents back that were inserted before; others raise, and nothing changes."""
        self._update(docs, -1)

    def _update(self, docs: DataFrame, sign: int) -> None:
        prepare(self.spark)
        found = docs.select("text").mapInArrow(_count_rows(self.min_chars, self.shards), _COUNTS)
        change = found.withColumn("n", F.col("n") * sign).withColumn("old", F.lit(0).cast("bigint"))
        before = self.counts().withColumn("old", F.col("n"))
        after = before.unionByName(change).groupBy("key").agg(F.first("shard").alias("shard"), F.sum("n").alias("n"), F.sum("old").alias("old"))
        following = self.version + 1
        staged = f"{self.path}/staged-{following}"
        after.select("shard", "key", "n", "old").write.mode("overwrite").parquet(staged)
        table_ = self.spark.read.schema(f"{_COUNTS}, old bigint").parquet(staged)
        if sign < 0 and not table_.where("n < 0").isEmpty():
            raise ValueError("a document is to be taken back that was never inserted")
        least = self.min_documents
        near = table_.where((F.col("n") >= least) | (F.col("old") >= least)).select("shard", "key", (F.col("n") >= least).alias("now"), (F.col("old") >= least).alias("was"))
        updated = (
            self.filters().groupBy("shard").cogroup(near.groupBy("shard")).applyInPandas(_updated_filter, "shard int, cells binary")
        )
        updated.write.mode("overwrite").parquet(f"{self.path}/filters-{following}")
        table_.where("n > 0").select("shard", "key", "n").write.mode("overwrite").parquet(f"{self.path}/counts-{following}")
        write_note(self.spark, f"{self.path}/version", str(following))
        self.version = following

    def repeated(self) -> DataFrame:
        """(key) of the lines that stand in at least ``min_documents`` documents."""
        return self.counts().where(F.col("n") >= self.min_documents).select("key")

    def without_repeated_lines(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the repeated lines taken out of ``text``; adds n_lines and n_dropped.

        A text is split at line feeds; a null text is one empty line, and so is an empty
        one. Every occurrence of a repeated line goes, the other lines stay as they are.
        A document whose lines all go keeps its row with an empty text. Columns of ``docs``
        that are called n_lines or n_dropped are replaced.
        """
        prepare(self.spark)
        names, inner = carried(docs, ("n_lines", "n_dropped"))
        schema = extended(inner, "n_lines bigint, n_dropped bigint")
        text = f"c{names.index('text')}"
        inner = inner.withColumn("text_key", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
        lines = inner.select("text_key", F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
            _candidate_rows(self._sent_filters(), self.min_chars, self.shards), "text_key string, key binary, line int"
        )
        # What is dropped from a text depends on the text alone. Equal texts give their lines once.
        confirmed = lines.distinct().join(self.repeated(), "key", "left_semi")
        dropped = confirmed.groupBy("text_key").agg(F.collect_list("line").alias("lines"))
        joined = inner.join(dropped, "text_key", "left").drop("text_key")
        done = joined.mapInArrow(_dropping_rows(text), schema)
        return done.select(*restored(names), "n_lines", "n_dropped")

    def _sent_filters(self):
        """All filters as a broadcast, or None where they are too large for that."""
        size = self.filters().agg(F.sum(F.length("cells"))).first()[0] or 0
        if size > FILTER_LIMIT_BYTES:
            return None
        return self.spark.sparkContext.broadcast({row["shard"]: bytes(row["cells"]) for row in self.filters().collect()})


def _count_rows(min_chars: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bytes, int] = {}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                for key in {line_key(line) for line in (text or b"").split(b"\n")}:
                    if not _short(key, min_chars):
                        counts[key] = counts.get(key, 0) + 1
            keys = [_key_hash(key) for key in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_shards_of(keys, shards), pa.int32()), pa.array(keys, pa.binary()), pa.array(list(counts.values()), pa.int64())],
                ["shard", "key", "n"],
            )

    return run


def _shards_of(keys: list[bytes], shards: int) -> list[int]:
    return [int.from_bytes(key[8:12], "little") % shards for key in keys]


def _filter_keys(keys) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(key)[:8] for key in keys), np.uint64)


def _updated_filter(old: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after some keys came and others went; a full one is built anew."""
    shard = int(old["shard"].iloc[0] if len(old) else near["shard"].iloc[0])
    now, was = near["now"].to_numpy(bool), near["was"].to_numpy(bool)
    keys = near["key"]
    current = CuckooFilter.from_bytes(bytes(old["cells"].iloc[0])) if len(old) else None
    if current is not None:
        for key in _filter_keys(keys[was & ~now]).tolist():
            current.delete(key)
        if not all(current.insert(key) for key in _filter_keys(keys[now & ~was]).tolist()):
            current = None
    if current is None:
        current = CuckooFilter.build(_filter_keys(keys[now]))
    return pd.DataFrame({"shard": [shard], "cells": [current.to_bytes()]})


def _candidate_rows(sent, min_chars: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = None if sent is None else {shard: CuckooFilter.from_bytes(cells) for shard, cells in sent.value.items()}
        for batch in batches:
            texts, keys, numbers = [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                for number, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if not _short(key, min_chars):
                        texts.append(row)
                        keys.append(_key_hash(key))
                        numbers.append(number)
            held = np.ones(len(keys), bool)
            if filters is not None and keys:
                words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
                shard_of = np.array(_shards_of(keys, shards))
                held[:] = False
                for shard, cells in filters.items():
                    at = np.flatnonzero(shard_of == shard)
                    held[at] = cells.contains(words[at, 0])
            kept = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("text_key").take(pa.array([texts[k] for k in kept], pa.int64())),
                    pa.array([keys[k] for k in kept], pa.binary()),
                    pa.array([numbers[k] for k in kept], pa.int32()),
                ],
                ["text_key", "key", "line"],
            )

    return run


def _dropping_rows(text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            texts, counts, gone = [], [], []
            for text, lines in zip(batch.column(at).to_pylist(), batch.column("lines").to_pylist(), strict=True):
                parts = (text or "").split("\n")
                counts.append(len(parts))
                gone.append(len(lines or ()))
                if lines:
                    drop = set(lines)
                    text = "\n".join(part for number, part in enumerate(parts) if number not in drop)
                texts.append(text)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, batch.column(at).type)
            names = [*batch.schema.names[:-1], "n_lines", "n_dropped"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], names)

    return run


def without_repeated_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``LineIndex`` over ``docs`` alone: counts its lines and takes the repeated ones out.

    Every row is a document of its own, also where a doc_id or a text comes twice.
    """
    index = LineIndex(docs.sparkSession, scratch_path(docs.sparkSession, "line-index"), min_documents, min_chars)
    index.insert(docs)
    return index.without_repeated_lines(docs)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return done.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


SQL = """
with lines as (
  select rid, doc_id, pos, line, translate(trim(line, e' \\t\\n\\x0b\\f\\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select rid, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos
        from (select row_number() over () as rid, doc_id, string_split(coalesce("text", ''), chr(10)) as parts from documents))
), often as (
  select key from lines where length(key) >= 1 group by key having count(distinct rid) >= 10
), marked as (
  select l.*, o.key is not null as gone from lines l left join often o on l.key = o.key
)
select doc_id, count(*) as n_lines, count_if(gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by rid, doc_id
"""
