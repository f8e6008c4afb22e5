"""Concatenate and cut: documents become one token stream, cut into fixed windows."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import document_rows, prepare, stored, table

# Fixed values of the contract: window length and the id that ends a document.
WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k"
# Encoded pieces a worker remembers; when full it starts anew.
REMEMBERED = 250_000

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"
)


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the ranks of a public vocabulary lie; they hold the ids of its ``.json`` file."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


class Encoder:
    """Ids of a text, remembering those of each blank-separated piece.

    The vocabulary's pattern starts a new token at every single blank that follows a
    non-blank and precedes one. A text is cut there and each piece encoded once. A text
    with other runs of white space next to a blank is encoded as a whole. Strings of added
    tokens get the ids that the vocabulary's ``.json`` file gives them.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
            self.added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        ranks = {token: rank for token, rank in ranks.items() if rank not in set(self.added.values())}
        self.encoding = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        # Two bytes an id where they are enough.
        self.dtype = np.dtype("<u2") if self.encoding.max_token_value < 1 << 16 else np.dtype("<u4")
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids as bytes of ``dtype``."""
        if any(token in text for token in self.added):
            return np.array(self.encoding.encode(text, allowed_special="all"), self.dtype).tobytes()
        first, *others = text.split(" ")
        if any(piece == "" or piece[0].isspace() for piece in others):
            return self._plain(text)
        known = self.known
        out = [self._plain(first)]
        try:
            out += [known[piece] for piece in others]
        except KeyError:
            del out[1:]
            for piece in others:
                ids = known.get(piece)
                if ids is None:
                    ids = known[piece] = self._plain(" " + piece)
                out.append(ids)
            if len(known) > REMEMBERED:
                known.clear()
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), self.dtype).tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def packed_pieces(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    A document's tokens are the ids of its text and ``end_id``. All documents stand one
    after another in a single stream that is cut every ``window`` ids: only the last
    sequence can be short, and a document lies in as many pieces as it has windows.

    Two passes: the first encodes each text once, stores the ids and each document's place
    among those of its partition; the partitions' totals are summed up; the second reads
    the ids back in place and cuts. No ids are shuffled. Only one row per partition of the
    input, 16 bytes each, is broadcast.

    A null or empty text is the end id alone. Rows without doc_id are packed like others;
    rows that repeat a doc_id are documents of their own. Other columns are ignored. An
    empty table gives no rows.
    """
    prepare(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    encoded = stored(
        document_rows(docs).mapInArrow(_encode_rows(path, end_id), "part int, doc_id bigint, before bigint, n bigint, ids binary"),
        "token-ids",
    )
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    placed = encoded.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    return placed.mapInArrow(_cut_rows(path, window), _PIECES)


def _encode_rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        encoder.known.clear()
        before = 0
        for batch in batches:
            ids = [encoder.encode(text) + end for text in batch.column("text").to_pylist()]
            counts = np.array([len(one) // encoder.dtype.itemsize for one in ids], np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, np.int32)), batch.column("doc_id"), pa.array(starts), pa.array(counts), pa.array(ids, pa.binary())],
                ["part", "doc_id", "before", "n", "ids"],
            )
        # Workers outlive tasks; what they remember must not add up with other stages' needs.
        encoder.known.clear()

    return run


def _cut_rows(path: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = _encoder(path).dtype
        for batch in batches:
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("doc_id", "at", "n"))
            for doc_id, at, n, ids in zip(*columns, batch.column("ids"), strict=True):
                values = np.frombuffer(ids.as_buffer(), dtype).astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, n - start)
                    crc = zlib.crc32(values[start : start + length].tobytes())
                    rows.append((doc_id, start, length, crc, n, sequence, offset))
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)

    return run


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))
