"""The three daily KPI tables, for all days of a frame in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import MAX_RANK, date_rank, date_text, padded_rank


def compute_daily_genre_kpis(enriched: DataFrame) -> DataFrame:
    """Per (genre, date): plays, unique listeners, total and average listening time.

    The distinct count is exact. Spark first reduces to one row per (genre, day,
    user) on the map side, so neither a hot genre nor a hot user gathers in a task.
    """
    return (
        enriched.groupBy("track_genre", "listen_date")
        .agg(
            F.count(F.lit(1)).alias("listen_count"),
            F.countDistinct("user_id").alias("unique_listeners"),
            F.sum("duration_ms").alias("total_listening_time_ms"),
            F.try_divide(F.sum("duration_ms"), F.countDistinct("user_id"))
            .cast("double")
            .alias("avg_listening_time_per_user_ms"),
        )
        .select(
            F.col("track_genre").alias("genre"),
            "listen_count",
            "unique_listeners",
            "total_listening_time_ms",
            "avg_listening_time_per_user_ms",
            date_text(F.col("listen_date")).alias("date"),
        )
    )


def compute_top_songs_per_genre(enriched: DataFrame, listen_date: str | None = None, n: int = 3) -> DataFrame:
    """The n most played songs of each genre and day. Ties go to the lower id, then name.

    ``listen_date`` narrows the result to one day.
    """
    counts = (
        _one_day(enriched, listen_date)
        .groupBy("listen_date", "track_genre", "track_id", "track_name")
        .agg(F.count(F.lit(1)).alias("listen_count"))
    )
    best = top_of_group(counts, ["listen_date", "track_genre"], n, F.col("track_id"), F.col("track_name"))
    return best.select(
        F.col("track_genre").alias("genre"),
        "track_id",
        "track_name",
        "listen_count",
        "rank",
        date_rank(F.col("listen_date"), F.col("rank")).alias("date_rank"),
        date_text(F.col("listen_date")).alias("date"),
    )


def compute_top_genres_daily(enriched: DataFrame, listen_date: str | None = None, n: int = 5) -> DataFrame:
    """The n most played genres of each day. Ties go to the genre first by name."""
    counts = (
        _one_day(enriched, listen_date)
        .groupBy(date_text(F.col("listen_date")).alias("date"), F.col("track_genre").alias("genre"))
        .agg(F.count(F.lit(1)).alias("listen_count"))
    )
    return rank_genres(counts, n)


def rank_genres(daily: DataFrame, n: int = 5) -> DataFrame:
    """The top-genres table out of (date, genre, listen_count) rows.

    The daily genre KPIs hold just these counts, so a load that has them needs no
    further pass over the plays.
    """
    return top_of_group(daily, ["date"], n, F.col("genre")).select(
        "date", padded_rank(F.col("rank")).alias("rank"), "genre", "listen_count"
    )


def _one_day(enriched: DataFrame, listen_date: str | None) -> DataFrame:
    if listen_date is None:
        return enriched
    return enriched.where(F.col("listen_date") == F.lit(listen_date).cast("date"))


def top_of_group(counts: DataFrame, group: list[str], n: int, *tie_breaks: Column) -> DataFrame:
    # Spark prunes each task's rows to n per group before the shuffle of the
    # window, so a group reaches its task as at most n rows per upstream task.
    if not 1 <= n <= MAX_RANK:
        raise ValueError(f"n must be between 1 and {MAX_RANK}: ranks are two-character keys")
    order = [F.col("listen_count").desc(), *[column.asc_nulls_last() for column in tie_breaks]]
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)
