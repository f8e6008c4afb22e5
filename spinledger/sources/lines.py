"""Raw text lines with the place they came from.

A line is (file, block, pos, value). A block is one input split of a file, blocks
of a file are ordered by their offset, and ``pos`` counts up by one inside a block.
That is enough to number the lines of a file of any size without ever bringing
the file into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Only line feeds end a line; the carriage return of a CRLF file is cut below.
_TEXT_OPTIONS = {"lineSep": "\n", "recursiveFileLookup": "true"}


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of every file at or below ``path``, or several paths.

    A split is read by one task in order, so the ids that number its lines are dense.
    """
    located = _located(spark.read.options(**_TEXT_OPTIONS).text(path))
    return located.select("file", "block", F.monotonically_increasing_id().alias("pos"), "value")


def _located(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)"))
        .otherwise(F.col("value"))
        .alias("value"),
    )
