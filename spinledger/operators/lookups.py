"""Reads over the three KPI tables. Each is a filter the scan can prune by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import minutes


def genre_on_day(daily: DataFrame, genre: str, date: str) -> DataFrame:
    return daily.where((F.col("genre") == genre) & (F.col("date") == date))


def genre_history(daily: DataFrame, genre: str) -> DataFrame:
    return daily.where(F.col("genre") == genre).orderBy("date")


def scan_daily(daily: DataFrame) -> DataFrame:
    return daily.select(
        F.col("genre").alias("Genre"),
        F.col("date").alias("Date"),
        F.col("listen_count").alias("Listens"),
        F.col("unique_listeners").alias("UniqueUsers"),
        F.col("avg_listening_time_per_user_ms").alias("AvgMsPerUser"),
    )


def min_listens(daily: DataFrame, more_than: int = 100) -> DataFrame:
    return daily.where(F.col("listen_count") > more_than)


def average_minutes(daily: DataFrame, genre: str | None = None) -> DataFrame:
    """Minutes per listener for a dashboard, of one genre or of all."""
    rows = daily if genre is None else daily.where(F.col("genre") == genre)
    return rows.select(
        "genre",
        "date",
        minutes(F.col("avg_listening_time_per_user_ms")).alias("avg_minutes"),
        "unique_listeners",
    )


def top_songs_on_day(top_songs: DataFrame, genre: str, date: str) -> DataFrame:
    """All ranks of a genre and day, by the prefix of the sort key.

    The equal ``date`` is implied by the prefix; it lets a table partitioned by
    date skip every other day.
    """
    return top_songs.where(
        (F.col("genre") == genre) & (F.col("date") == date) & F.col("date_rank").startswith(f"{date}#")
    ).orderBy("date_rank")


def top_songs_history(top_songs: DataFrame, genre: str) -> DataFrame:
    return top_songs.where(F.col("genre") == genre).orderBy("date_rank")


def top_song_of_genres(top_songs: DataFrame, genres: Sequence[str], date: str) -> DataFrame:
    """The number one of several genres on a day."""
    return top_songs.where(
        F.col("genre").isin(list(genres)) & (F.col("date") == date) & (F.col("date_rank") == f"{date}#01")
    )


def top_genres_on_day(top_genres: DataFrame, date: str) -> DataFrame:
    return top_genres.where(F.col("date") == date).orderBy("rank")


def top_genre_on_day(top_genres: DataFrame, date: str) -> DataFrame:
    return top_genres.where((F.col("date") == date) & (F.col("rank") == "01"))
