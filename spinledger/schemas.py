"""Row types, key lists and table layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The header every stream file must carry, in this order and case.
STREAM_COLUMNS = ["user_id", "track_id", "listen_time"]

CORRUPT_COLUMN = "_corrupt"

STREAM = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("track_id", T.StringType()),
        T.StructField("listen_time", T.TimestampType()),
    ]
)

# The record of one text line before any typing; a line with too few or too many
# fields also fills the corrupt column.
STREAM_RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in STREAM_COLUMNS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

# Reference columns that are not text. Every other column stays a string.
SONG_TYPES = {"duration_ms": "bigint"}
USER_TYPES = {"user_age": "bigint"}

VERDICT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("data_rows", T.LongType()),
    ]
)

MANIFEST = T.StructType([T.StructField("dates", T.ArrayType(T.StringType()))])

# The composite keys of the three KPI tables.
DAILY_GENRE_KEYS = ["genre", "date"]
TOP_SONGS_KEYS = ["genre", "date_rank"]
TOP_GENRES_KEYS = ["date", "rank"]

# The attributes of an item per KPI table; text or number.
DAILY_GENRE_ITEM = {
    "genre": "text",
    "date": "text",
    "listen_count": "number",
    "unique_listeners": "number",
    "total_listening_time_ms": "number",
    "avg_listening_time_per_user_ms": "number",
}
TOP_SONGS_ITEM = {
    "genre": "text",
    "date_rank": "text",
    "track_id": "text",
    "track_name": "text",
    "listen_count": "number",
    "date": "text",
    "rank": "number",
}
TOP_GENRES_ITEM = {
    "date": "text",
    "rank": "text",
    "genre": "text",
    "listen_count": "number",
}


@dataclass(frozen=True)
class Layout:
    """Where the tables of one deployment live, all below one shared root."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def enriched(self) -> str:
        return self._at("enriched_streams")

    @property
    def verdicts(self) -> str:
        return self._at("verdicts")

    @property
    def splits(self) -> str:
        return self._at("splits")

    @property
    def quarantine(self) -> str:
        return self._at("quarantine")

    @property
    def daily_genre(self) -> str:
        return self._at("daily_genre_kpis")

    @property
    def top_songs(self) -> str:
        return self._at("top_songs_per_genre")

    @property
    def top_genres(self) -> str:
        return self._at("top_genres_daily")

    @property
    def rejected_items(self) -> str:
        return self._at("rejected_items")

    @property
    def user_partials(self) -> str:
        return self._at("user_partials")

    @property
    def song_partials(self) -> str:
        return self._at("song_partials")

    @property
    def lease(self) -> str:
        return self._at("lease")

    @property
    def run_metrics(self) -> str:
        return self._at("run_metrics")

    @property
    def arrivals(self) -> str:
        return self._at("arrivals")

    @property
    def attempts(self) -> str:
        return self._at("attempts")

    def finished(self, source_id: str) -> str:
        return self._at(f"finished/{source_id}")

    @property
    def moves(self) -> str:
        return self._at("moves")

    def staged(self, source_id: str) -> str:
        return self._at(f"staged/{source_id}")

    def manifest(self, source_id: str) -> str:
        return self._at(f"manifests/{source_id}.json")
