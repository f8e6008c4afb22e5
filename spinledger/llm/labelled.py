"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import document_rows, stored

# Bytes of text that a sample holds at most.
SAMPLE_BYTES = 48 << 20


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; null without a doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def is_remainder(modulus: int, rest: int) -> Column:
    """Whether a row is held out; a row without doc_id is not."""
    return F.coalesce(remainder(modulus) == rest, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int):
    """(rows (text, label), share of label 1 among all labels that may be learned from).

    At most ``per_class`` documents of each label, by the hash of their id, and of these, in
    the same order, as many as hold ``SAMPLE_BYTES`` of text together. Labels that are
    null or name held-out documents are left out; of contradictory labels for one document
    the larger counts.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~is_remainder(modulus, held_out) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(label).alias("label"))
    )
    share = known.agg(F.avg("label")).first()[0]
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("label = 0").orderBy(*order).limit(per_class).unionByName(known.where("label = 1").orderBy(*order).limit(per_class))
    # A repeated doc_id could bring any number of texts; each id gives one.
    found = document_rows(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    found = stored(found, "labelled-texts")
    sizes = found.select("doc_id", F.octet_length("text").alias("size")).orderBy(*order).collect()
    within, total = [], 0
    for row in sizes:
        total += row["size"]
        if total > SAMPLE_BYTES:
            break
        within.append(row["doc_id"])
    rows = found.where(F.col("doc_id").isin(within)).collect() if len(within) < len(sizes) else found.collect()
    rows.sort(key=lambda row: row["doc_id"])
    return [(row["text"], int(row["label"])) for row in rows], 0.5 if share is None else float(share)
