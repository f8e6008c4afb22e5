"""From touched days to the three KPI tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.kpis import rank_genres
from ..operators.partials import daily_genre_of_partials, song_partials, top_songs_of_partials, user_partials
from ..operators.upsert import with_complete_key, with_incomplete_key
from ..schemas import DAILY_GENRE_KEYS, TOP_GENRES_KEYS, TOP_SONGS_KEYS, Layout
from ..sources.partials import read_partials, slice_versions
from ..sources.tables import clear_partitions, read_enriched, write_days

TOP_SONGS = 3
TOP_GENRES = 5

NOTHING = {"daily_genre_items": 0, "top_songs_items": 0, "top_genres_items": 0, "rejected_items": 0}


def refresh_kpis(
    spark: SparkSession,
    layout: Layout,
    dates: Sequence[str],
    n_songs: int = TOP_SONGS,
    n_genres: int = TOP_GENRES,
) -> dict[str, int]:
    """Recompute the given days from all their arrivals and replace them in each table.

    Days are recomputed whole, so late files, reruns and several files per day all
    come out right. Each arrival of a day is summed up once, per user and per song, and its
    sums are stored: a late file costs a read of its own plays and of the sums of the others.
    """
    if not dates:
        return dict(NOTHING)
    slices = slice_versions(spark, layout.enriched, dates)
    tables = {layout.user_partials: user_partials, layout.song_partials: song_partials}
    users, plays = read_partials(spark, layout.enriched, tables, slices)
    if users is None or plays is None:
        enriched = read_enriched(spark, layout.enriched, dates)
        users, plays = user_partials(enriched), song_partials(enriched)
    # Summaries feed a table, a ranking and the reject list. They hold one row per
    # genre or ranked song and day; a lost block is recomputed from the store.
    daily = daily_genre_of_partials(users).persist(StorageLevel.MEMORY_AND_DISK)
    songs = top_songs_of_partials(plays, n_songs).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        genres = rank_genres(daily.select("date", "genre", "listen_count"), n_genres)
        written = {
            "daily_genre_items": _write(daily, DAILY_GENRE_KEYS, layout.daily_genre, dates),
            "top_songs_items": _write(songs, TOP_SONGS_KEYS, layout.top_songs, dates),
            "top_genres_items": _write(genres, TOP_GENRES_KEYS, layout.top_genres, dates),
        }
        rejected = _rejected(daily, DAILY_GENRE_KEYS, "daily_genre_kpis").unionByName(
            _rejected(songs, TOP_SONGS_KEYS, "top_songs_per_genre")
        )
        written["rejected_items"] = _report(spark, rejected, layout.rejected_items, dates)
    finally:
        daily.unpersist()
        songs.unpersist()
    return written


def _write(rows: DataFrame, keys: list[str], path: str, dates: Sequence[str]) -> int:
    return write_days(with_complete_key(rows, keys), path, dates)


def _rejected(rows: DataFrame, keys: list[str], table: str) -> DataFrame:
    bad = with_incomplete_key(rows, keys)
    item = F.to_json(F.struct(*rows.columns)).alias("item")
    return bad.select("date", F.lit(table).alias("table"), "reason", item)


def _report(spark: SparkSession, rejected: DataFrame, path: str, dates: Sequence[str]) -> int:
    if rejected.isEmpty():
        clear_partitions(spark, path, [f"date={day}" for day in dates])
        return 0
    return write_days(rejected, path, dates)
