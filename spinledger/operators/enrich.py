"""Plays joined to songs and users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.iso import iso_timestamp


def enrich_streams(
    streams: DataFrame, songs: DataFrame, users: DataFrame, join_hint: str | None = None
) -> DataFrame:
    """streams ⋈ songs on track_id ⋈ users on user_id, plus ``listen_date``.

    Plays without a known song or user drop out; a song or user listed twice
    multiplies its plays. Columns: user_id, track_id, the rest of the streams,
    songs and users, then listen_date.

    No side is broadcast by decree. While a reference table is within
    ``spark.sql.autoBroadcastJoinThreshold`` Catalyst broadcasts it and the plays
    are not shuffled at all; a catalogue that outgrows the bound is joined by
    shuffle, where adaptive execution splits the partitions of hot tracks and
    users. ``join_hint`` ("merge", "shuffle_hash") pins a shuffled join.
    """
    listen_time = F.col("listen_time")
    if dict(streams.dtypes)["listen_time"] == "string":
        listen_time = iso_timestamp(listen_time)
    if join_hint:
        songs, users = songs.hint(join_hint), users.hint(join_hint)
    keys = ["user_id", "track_id"]
    rest = [name for side in (streams, songs, users) for name in side.columns if name not in keys]
    # Users outgrow a broadcast first. Joined first, their shuffle moves bare plays,
    # and the wide song columns are added after it.
    return (
        streams.join(users, "user_id", "inner")
        .join(songs, "track_id", "inner")
        .select(*keys, *rest, F.to_date(listen_time).alias("listen_date"))
    )
