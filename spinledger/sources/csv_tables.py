"""CSV scans of plays and of the two reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SONG_TYPES, STREAM, USER_TYPES


def read_streams(spark: SparkSession, path: str) -> DataFrame:
    """Plays of already validated files: fixed schema, no inference pass."""
    return spark.read.schema(STREAM).csv(path, header=True, escape='"')


def read_songs(spark: SparkSession, path: str) -> DataFrame:
    return _read_reference(spark, path, SONG_TYPES)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return _read_reference(spark, path, USER_TYPES)


def _read_reference(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    # Columns are found by header name, so files may order or extend them freely.
    # Ids stay text: both sides of each join then have the same type by contract.
    raw = spark.read.csv(path, header=True, escape='"')
    return raw.select(
        [
            F.col(f"`{name}`").try_cast(types[name]).alias(name) if name in types else F.col(f"`{name}`")
            for name in raw.columns
        ]
    )
