"""Daily sums that add up: per arrival of a day, from which the KPI tables are refreshed.

Counts and sums of arrivals add up as they are. Listeners do not, as one user may occur in
several arrivals, so the sums are kept per user and the distinct count stays exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import date_rank, date_text
from .kpis import top_of_group

USER_GROUP = ["listen_date", "track_genre", "user_id"]
SONG_GROUP = ["listen_date", "track_genre", "track_id", "track_name"]


def user_partials(enriched: DataFrame, *slices: str) -> DataFrame:
    """(day, genre, user): plays and listening time, for each value of the columns ``slices``."""
    return enriched.groupBy(*USER_GROUP, *slices).agg(F.count(F.lit(1)).alias("listens"), F.sum("duration_ms").alias("listening_ms"))


def song_partials(enriched: DataFrame, *slices: str) -> DataFrame:
    """(day, genre, song): plays, for each value of the columns ``slices``."""
    return enriched.groupBy(*SONG_GROUP, *slices).agg(F.count(F.lit(1)).alias("listens"))


def daily_genre_of_partials(partials: DataFrame) -> DataFrame:
    """The daily genre KPIs out of the user partials of all arrivals of the days."""
    users = F.countDistinct("user_id")
    return partials.groupBy(F.col("track_genre").alias("genre"), "listen_date").agg(
        F.sum("listens").alias("listen_count"),
        users.alias("unique_listeners"),
        F.sum("listening_ms").alias("total_listening_time_ms"),
        F.try_divide(F.sum("listening_ms"), users).cast("double").alias("avg_listening_time_per_user_ms"),
    ).withColumn("date", date_text(F.col("listen_date"))).drop("listen_date")


def top_songs_of_partials(partials: DataFrame, n: int = 3) -> DataFrame:
    """The top songs out of the song partials of all arrivals of the days."""
    counts = partials.groupBy(*SONG_GROUP).agg(F.sum("listens").alias("listen_count"))
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
