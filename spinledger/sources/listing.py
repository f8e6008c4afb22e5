"""Which files lie below a folder, as a frame: one row per version of a file."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import empty_version

VERSION = "file string, modified timestamp, length bigint"
_HOSTLESS = re.compile("^([A-Za-z][A-Za-z0-9+.-]*):///")


def file_versions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, modified, length) of every file at or below ``path``, empty ones included.

    Spark lists the files, many folders by a job; no file is opened, since the content
    column is not asked for. ``file`` is spelled as a text scan's metadata spells it. A scan
    leaves empty files out, so those are the listed names that it does not return; the
    file system is asked for the times of these alone.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    full = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
    )
    # The names are those of the listing that a scan keeps on the driver as well.
    # It writes a store without a host with three slashes, a scan with one.
    named = spark.createDataFrame([(_HOSTLESS.sub(r"\1:/", name),) for name in files.inputFiles()], "file string")
    empty = [version for row in named.join(full, "file", "left_anti").collect() if (version := empty_version(spark, row["file"]))]
    return full.unionByName(spark.createDataFrame(empty, VERSION)) if empty else full


def zero_length_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Files without a single byte (file). A text scan never shows them."""
    return file_versions(spark, path).where("length = 0").select("file")
