"""Joins of plays with songs and users."""

import datetime as dt

import pytest

from spinledger.operators.enrich import enrich_streams


@pytest.fixture(scope="module")
def songs(spark):
    return spark.createDataFrame(
        [("m-4", "Harbour", "folk", "Ida", 61000), ("m-9", "Echo", "dub", "Juno", 240000)],
        "track_id string, track_name string, track_genre string, artists string, duration_ms bigint",
    )


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("ann", "Ann", 41, "PT"), ("ben", "Ben", 19, "FI")],
        "user_id string, user_name string, user_age bigint, user_country string",
    )


@pytest.fixture(scope="module")
def streams(spark):
    return spark.createDataFrame(
        [
            ("ben", "m-9", "2023-11-02 23:59:59"),
            ("ann", "m-4", "2023-11-05"),
            ("ann", "m-9", "2023-11-02T08"),
            ("ben", "lost", "2023-11-05 07:30"),
            ("ann", "m-4", "2023-11-05 20:15:00.250"),
        ],
        "user_id string, track_id string, listen_time string",
    )


def keys(frame):
    return sorted((row["user_id"], row["track_id"], str(row["listen_date"])) for row in frame.collect())


def test_unknown_song_drops_out(streams, songs, users):
    assert keys(enrich_streams(streams, songs, users)) == [
        ("ann", "m-4", "2023-11-05"),
        ("ann", "m-4", "2023-11-05"),
        ("ann", "m-9", "2023-11-02"),
        ("ben", "m-9", "2023-11-02"),
    ]


def test_unknown_user_drops_out(streams, songs, users):
    assert keys(enrich_streams(streams, songs, users.where("user_id = 'ben'"))) == [("ben", "m-9", "2023-11-02")]


def test_columns_and_types(streams, songs, users):
    enriched = enrich_streams(streams, songs, users)
    assert enriched.columns == [
        "user_id", "track_id", "listen_time", "track_name", "track_genre", "artists", "duration_ms",
        "user_name", "user_age", "user_country", "listen_date",
    ]
    assert dict(enriched.dtypes)["listen_date"] == "date"


def test_duplicate_song_multiplies(streams, songs, users):
    doubled = songs.unionByName(songs.where("track_id = 'm-9'"))
    assert keys(enrich_streams(streams, doubled, users)).count(("ben", "m-9", "2023-11-02")) == 2


def test_null_keys_never_match(spark, songs, users):
    streams = spark.createDataFrame(
        [(None, "m-4", "2023-11-02"), ("ann", None, "2023-11-02")],
        "user_id string, track_id string, listen_time string",
    )
    assert enrich_streams(streams, songs, users).count() == 0


def test_empty_streams_keep_the_schema(streams, songs, users):
    empty = enrich_streams(streams.limit(0), songs, users)
    assert empty.count() == 0 and "listen_date" in empty.columns


def test_offset_decides_the_day(spark, songs, users):
    streams = spark.createDataFrame(
        [("ann", "m-4", "2023-11-02 23:30:00-05:00")], "user_id string, track_id string, listen_time string"
    )
    assert enrich_streams(streams, songs, users).first()["listen_date"] == dt.date(2023, 11, 3)


def test_numeric_ids_and_timestamps(spark):
    streams = spark.createDataFrame(
        [(1, 7, dt.datetime(2024, 6, 25, 23, 59))], "user_id bigint, track_id bigint, listen_time timestamp_ntz"
    )
    songs = spark.createDataFrame([(7, "S")], "track_id bigint, track_name string")
    users = spark.createDataFrame([(1, "A")], "user_id bigint, user_name string")
    assert enrich_streams(streams, songs, users).first()["listen_date"] == dt.date(2024, 6, 25)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hint, operator", [("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")])
def test_shuffled_joins_give_the_same_rows(streams, songs, users, hint, operator):
    shuffled = enrich_streams(streams, songs, users, join_hint=hint)
    assert operator in plan_of(shuffled) and "BroadcastHashJoin" not in plan_of(shuffled)
    assert keys(shuffled) == keys(enrich_streams(streams, songs, users))


def test_broadcast_depends_on_the_measured_size(spark, streams, songs, users, tmp_path):
    songs.write.parquet(str(tmp_path / "songs"))
    users.write.parquet(str(tmp_path / "users"))
    streams.write.parquet(str(tmp_path / "streams"))
    read = [spark.read.parquet(str(tmp_path / name)) for name in ("streams", "songs", "users")]
    small = enrich_streams(*read)
    assert "SortMergeJoin" not in plan_of(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        large = enrich_streams(*read)
        assert plan_of(large).count("SortMergeJoin") == 2 and "Broadcast" not in plan_of(large)
        got = keys(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == keys(small)
