"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinledger.llm.decontamination import decontaminated
from spinledger.llm.line_dedup import without_repeated_lines
from spinledger.llm.minhash_dedup import deduplicated
from spinledger.llm.packing import packed_pieces
from spinledger.llm.quality import fitted_network, quality_scores
from spinledger.llm.tables import quoted, stored, table

# Near copies share so many words in a row in most of their runs.
SHINGLE_WORDS = 5
# A document goes if a larger part of its words than this stands in benchmark passages;
# below, only the passages are cut out.
MAX_COVERAGE = 0.05

# The classifier is a fitted network, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality network rejects."""
    network = fitted_network(docs, table(spark, sf_dir, "labels"))
    return quality_scores(docs, network).where("predicted = 1").select(*quoted(docs.columns))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that stand in many documents out of all of them."""
    done = without_repeated_lines(docs)
    return _with_length(done, F.col("n_dropped") > 0).select(*quoted(docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return deduplicated(docs, SHINGLE_WORDS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out, and drops documents that largely consist of them."""
    done = decontaminated(docs, table(spark, sf_dir, "benchmark"))
    kept = done.where(F.col("n_hit") <= MAX_COVERAGE * F.col("n_words"))
    return _with_length(kept, F.col("n_hit") > 0).select(*quoted(docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in the packed sequences."""
    return packed_pieces(docs)


def _with_length(docs: DataFrame, changed) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the whole pipeline makes of the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
