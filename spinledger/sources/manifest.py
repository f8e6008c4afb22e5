"""The dates manifest: which days a run touched, handed from transform to load."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import date_text
from ..schemas import MANIFEST


def dates_manifest(enriched: DataFrame) -> DataFrame:
    """One row (dates): the distinct days of a frame as sorted text, nulls left out."""
    days = enriched.select("listen_date").distinct()
    return days.agg(F.sort_array(F.collect_set(date_text(F.col("listen_date")))).alias("dates"))


def write_dates_manifest(spark: SparkSession, path: str, dates: Iterable[object]) -> list[str]:
    """Write the days as sorted, distinct text and return them. No days is valid."""
    normalized = sorted({str(day) for day in dates if day is not None})
    row = spark.createDataFrame([(normalized,)], MANIFEST)
    row.coalesce(1).write.mode("overwrite").json(path)
    return normalized


def read_dates_manifest(spark: SparkSession, path: str) -> list[str]:
    """The days of a manifest as text. Missing or malformed manifests raise."""
    options = {"mode": "FAILFAST", "multiLine": "true"}
    rows = spark.read.schema(MANIFEST).options(**options).json(path).head(2)
    if len(rows) != 1 or rows[0]["dates"] is None:
        raise ValueError(f"manifest {path} missing 'dates' list")
    return [str(day) for day in rows[0]["dates"]]
