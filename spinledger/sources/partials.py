"""Stored partial sums of the enriched plays, one slice per day, arrival and version of its files.

The version is a hash of the names and lengths of the files a slice was summed up from. A slice
that was written anew has other files, so its old sums are not found any more. Nothing has
to be marked as outdated, and a run that stops anywhere leaves no wrong sums behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import delete_folder, existing, files_below, names_below, side_by_side

SLICE = ["listen_date", "source_id", "version"]


def slice_versions(spark: SparkSession, path: str, dates: Iterable[str]) -> list[tuple[str, str, str]]:
    """(day, name of the arrival's folder, version) of the stored slices of the given days."""
    found: dict[tuple[str, str], list[str]] = {}
    days = sorted(set(dates))
    listed = side_by_side(lambda day: files_below(spark, f"{path}/listen_date={day}"), days)
    for day, files in zip(days, listed, strict=True):
        for folder, name, length in files:
            if folder.startswith("source_id=") and not name.startswith(("_", ".")):
                found.setdefault((day, folder), []).append(f"{name} {length}")
    return [
        (day, folder, "v-" + hashlib.md5("\n".join([day, folder, *sorted(files)]).encode()).hexdigest())
        for (day, folder), files in found.items()
    ]


def read_partials(
    spark: SparkSession,
    plays_path: str,
    tables: dict[str, Callable[..., DataFrame]],
    slices: Sequence[tuple[str, str, str]],
) -> list[DataFrame | None]:
    """The sums of the given slices, from each table; ``tables`` names how each is summed up.

    Only slices that lack sums of their version are read as plays; their sums are stored first.
    A slice without plays has no sums; None stands for a table without any.
    """
    names = {key: f"listen_date={key[0]}/{key[1]}/version={key[2]}" for key in slices}
    stored = [set(existing(spark, path, names.values())) for path in tables]
    new = [key for key, name in names.items() if any(f"{path}/{name}" not in found for path, found in zip(tables, stored, strict=True))]
    schemas: dict[str, T.StructType] = {}
    if new:
        plays, versions = _plays(spark, plays_path, new), _versions(spark, new)
        for path, summed in tables.items():
            # Summed up before the version joins: the few rows of the list meet sums, not plays.
            rows = summed(plays, "source_id").join(versions, ["listen_date", "source_id"])
            schemas[path] = rows.schema
            (
                rows.hint("rebalance", F.col("listen_date"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*SLICE)
                .parquet(path)
            )
            _drop_other_versions(spark, path, new)
    found = []
    for path in tables:
        present = existing(spark, path, names.values())
        reader = spark.read.option("basePath", path)
        if path in schemas:
            reader = reader.schema(schemas[path])
        found.append(reader.parquet(*present) if present else None)
    return found


def _plays(spark: SparkSession, path: str, slices: Sequence[tuple[str, str, str]]) -> DataFrame:
    folders = [f"{path}/listen_date={day}/{folder}" for day, folder, _ in slices]
    reader = spark.read.option("basePath", path)
    # Arrivals may have names that look like numbers: "007" has to stay what it is.
    fields = [T.StructField(field.name, T.StringType() if field.name == "source_id" else field.dataType) for field in reader.parquet(*folders).schema]
    return reader.schema(T.StructType(fields)).parquet(*folders)


def _versions(spark: SparkSession, slices: Sequence[tuple[str, str, str]]) -> DataFrame:
    rows = [(day, unquote(folder.partition("=")[2]), version) for day, folder, version in slices]
    versions = spark.createDataFrame(rows, "day string, source_id string, version string")
    return versions.withColumn("listen_date", F.col("day").cast("date")).drop("day")


def _drop_other_versions(spark: SparkSession, path: str, slices: Sequence[tuple[str, str, str]]) -> None:
    def drop(key: tuple[str, str, str]) -> None:
        day, folder, version = key
        for name in names_below(spark, f"{path}/listen_date={day}/{folder}"):
            if name.startswith("version=") and name != f"version={version}":
                delete_folder(spark, f"{path}/listen_date={day}/{folder}/{name}")

    side_by_side(drop, slices)
