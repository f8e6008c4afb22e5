"""Partitioned Parquet tables that are overwritten partition by partition."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import date_text
from .paths import existing, first_folder, replace_files


def read_enriched(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """The enriched plays, of all days or of the given ones.

    With dates, only those days' folders are listed and read, so the cost of a
    refresh does not depend on how much history there is. Days without a folder
    contribute nothing.
    """
    return _read_days(spark, path, "listen_date", dates)


def read_kpis(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """A KPI table, of all days or of the given ones; ``date`` is text."""
    rows = _read_days(spark, path, "date", dates)
    return rows.withColumn("date", date_text(F.col("date")))


def _read_days(spark: SparkSession, path: str, column: str, dates: Sequence[str] | None) -> DataFrame:
    if dates is None:
        return spark.read.parquet(path)
    present = existing(spark, path, [f"{column}={day}" for day in dates])
    if not present:
        # Any partition tells the schema; the history need not be listed for that.
        some = first_folder(spark, path, f"{column}=")
        if some is None:
            return spark.read.parquet(path).limit(0)
        return spark.read.option("basePath", path).parquet(some).limit(0)
    return spark.read.option("basePath", path).parquet(*present)


def write_enriched(
    enriched: DataFrame, path: str, source_id: str, rebalance: bool = True
) -> tuple[int, list[str]]:
    """Store one arrival's plays and return (rows written, days written).

    Partitions are (listen_date, source_id), so several arrivals of a day lie side
    by side and a rerun of one replaces just its own rows. Row count and days are
    observed on the write itself; the join is evaluated once.

    ``rebalance`` inserts a shuffle that evens out file sizes and splits hot days, so that
    a backfill whose files each span many days does not write a file per task and day.
    Without it tasks write straight from the join, which suits an arrival of one day.
    """
    rows = enriched.withColumn("source_id", F.lit(source_id))
    if rebalance:
        rows = rows.hint("rebalance", F.col("listen_date"))
    seen = _overwrite(rows, path, ["listen_date", "source_id"], date_text(F.col("listen_date")))
    return seen["rows"], sorted(seen["days"])


def write_days(rows: DataFrame, path: str, dates: Iterable[str]) -> int:
    """Replace the given days of a table partitioned by ``date``; returns the rows written.

    A day that has no rows any more is emptied as well.
    """
    spark = rows.sparkSession
    dates = set(dates)
    # A day of a summary is a handful of rows: one file per day, written in parallel.
    tasks = max(1, min(len(dates), spark.sparkContext.defaultParallelism))
    seen = _overwrite(rows.repartition(tasks, "date"), path, ["date"], F.col("date"))
    clear_partitions(spark, path, [f"date={day}" for day in sorted(dates - set(seen["days"]))])
    return seen["rows"]


def write_slice(rows: DataFrame, path: str, source_id: str) -> int:
    """Replace one arrival's rows in a table partitioned by ``source_id``."""
    observation = Observation()
    observed = rows.observe(observation, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").parquet(slice_path(path, source_id))
    return observation.get["rows"]


def slice_path(path: str, source_id: str) -> str:
    return f"{path}/source_id={source_id}"


def clear_partitions(spark: SparkSession, path: str, partitions: Iterable[str]) -> None:
    """Leave the named partitions, such as ``date=2024-06-25``, without rows.

    One job empties the first of them; the others get copies of its file, which tells the columns.
    """
    folders = existing(spark, path, partitions)
    if folders:
        spark.read.parquet(folders[0]).limit(0).write.mode("overwrite").parquet(folders[0])
        replace_files(spark, folders[0], folders[1:])


def changed_slices(
    spark: SparkSession, path: str, slices: Iterable[tuple[str, str]], files: DataFrame
) -> list[tuple[str, str]]:
    """Those (day, source_id) slices of the enriched plays that hold plays of ``files``."""
    stored = _read_slices(spark, path, slices)
    if "file" not in stored.columns:
        return []
    held = stored.join(files, "file", "left_semi").select(date_text(F.col("listen_date")).alias("day"), "source_id").distinct()
    return sorted((row["day"], row["source_id"]) for row in held.collect())


def drop_files(spark: SparkSession, path: str, slices: Sequence[tuple[str, str]], files: DataFrame, staging: str) -> None:
    """Rewrite slices without the plays of ``files``, by way of a staged copy."""
    kept = _read_slices(spark, path, slices).join(files, "file", "left_anti")
    kept.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(kept.schema).parquet(staging)
    left = {(row["day"], row["source_id"]) for row in staged.select(date_text(F.col("listen_date")).alias("day"), "source_id").distinct().collect()}
    _overwrite(staged.hint("rebalance", F.col("listen_date")), path, ["listen_date", "source_id"], date_text(F.col("listen_date")))
    clear_partitions(spark, path, [f"listen_date={day}/source_id={source}" for day, source in slices if (day, source) not in left])


def _read_slices(spark: SparkSession, path: str, slices: Iterable[tuple[str, str]]) -> DataFrame:
    folders = [f"{path}/listen_date={day}/source_id={source}" for day, source in slices]
    return spark.read.option("basePath", path).parquet(*folders)


def _overwrite(rows: DataFrame, path: str, partition_by: list[str], day: Column) -> dict:
    observation = Observation()
    (
        rows.observe(observation, F.count(F.lit(1)).alias("rows"), F.collect_set(day).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return observation.get
