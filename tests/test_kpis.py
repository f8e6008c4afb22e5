"""The three KPI tables on a hand-made frame: 10 plays, 2 days, 3 genres."""

import datetime as dt

import pytest

from spinledger.operators import kpis

FIRST, SECOND = dt.date(2023, 11, 2), dt.date(2023, 11, 5)
SCHEMA = (
    "user_id string, track_id string, listen_time string, track_name string, "
    "track_genre string, duration_ms bigint, listen_date date"
)
SONGS = {
    "s10": ("Harbour", "folk", 61000),
    "s20": ("Meadow", "folk", 183000),
    "s30": ("Echo", "dub", 240000),
    "s40": ("Aria", "opera", 522000),
}
PLAYS = [
    ("cat", "s20", FIRST), ("dee", "s20", FIRST), ("ann", "s30", FIRST), ("cat", "s10", FIRST), ("dee", "s20", FIRST),
    ("ann", "s30", FIRST), ("dee", "s10", FIRST), ("ben", "s40", SECOND), ("cat", "s40", SECOND), ("ben", "s10", SECOND),
]


def enriched_of(spark, plays, songs=SONGS):
    rows = []
    for user, track, day in plays:
        name, genre, duration = songs[track]
        rows.append((user, track, f"{day} 10:00:00", name, genre, duration, day))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def enriched(spark):
    return enriched_of(spark, PLAYS)


def test_daily_genre_kpis(enriched):
    rows = kpis.compute_daily_genre_kpis(enriched).select(
        "genre",
        "date",
        "listen_count",
        "unique_listeners",
        "total_listening_time_ms",
        "avg_listening_time_per_user_ms",
    )
    assert sorted(tuple(row) for row in rows.collect()) == [
        ("dub", "2023-11-02", 2, 1, 480000, 480000.0),
        ("folk", "2023-11-02", 5, 2, 671000, 335500.0),
        ("folk", "2023-11-05", 1, 1, 61000, 61000.0),
        ("opera", "2023-11-05", 2, 2, 1044000, 522000.0),
    ]


def test_daily_genre_schema(enriched):
    assert dict(kpis.compute_daily_genre_kpis(enriched).dtypes) == {
        "genre": "string",
        "date": "string",
        "listen_count": "bigint",
        "unique_listeners": "bigint",
        "total_listening_time_ms": "bigint",
        "avg_listening_time_per_user_ms": "double",
    }


def test_null_durations_and_users(spark):
    songs = {"a": ("A", "g", None), "b": ("B", "h", 10), "c": ("C", None, 5)}
    plays = [("u1", "a", FIRST), ("u1", "b", FIRST), (None, "b", FIRST), ("u1", "c", FIRST)]
    rows = {row["genre"]: row for row in kpis.compute_daily_genre_kpis(enriched_of(spark, plays, songs)).collect()}
    assert rows["g"]["total_listening_time_ms"] is None
    assert rows["g"]["avg_listening_time_per_user_ms"] is None
    assert (rows["h"]["listen_count"], rows["h"]["unique_listeners"]) == (2, 1)
    assert rows["h"]["avg_listening_time_per_user_ms"] == 20.0
    assert rows[None]["listen_count"] == 1


def test_no_listener_gives_no_average(spark):
    plays = [(None, "s10", FIRST)]
    row = kpis.compute_daily_genre_kpis(enriched_of(spark, plays)).first()
    assert (row["unique_listeners"], row["avg_listening_time_per_user_ms"]) == (0, None)


def test_top_songs(enriched):
    rows = kpis.compute_top_songs_per_genre(enriched, listen_date="2023-11-02").collect()
    got = sorted((r["genre"], r["rank"], r["track_id"], r["listen_count"], r["date_rank"], r["date"]) for r in rows)
    assert got == [
        ("dub", 1, "s30", 2, "2023-11-02#01", "2023-11-02"),
        ("folk", 1, "s20", 3, "2023-11-02#01", "2023-11-02"),
        ("folk", 2, "s10", 2, "2023-11-02#02", "2023-11-02"),
    ]


def test_top_songs_all_days_at_once(enriched):
    rows = kpis.compute_top_songs_per_genre(enriched).collect()
    assert len(rows) == 5
    assert sorted(r["track_id"] for r in rows if r["date"] == "2023-11-05") == ["s10", "s40"]


def test_top_songs_n(enriched):
    assert kpis.compute_top_songs_per_genre(enriched, listen_date="2023-11-02", n=1).count() == 2


def test_top_songs_schema(enriched):
    assert dict(kpis.compute_top_songs_per_genre(enriched).dtypes) == {
        "genre": "string",
        "date_rank": "string",
        "track_id": "string",
        "track_name": "string",
        "listen_count": "bigint",
        "rank": "int",
        "date": "string",
    }


def test_song_name_is_part_of_the_group(spark):
    rows = [("u1", "t1", "x", name, "pop", 1, FIRST) for name in ("B", "A", "B")]
    top = kpis.compute_top_songs_per_genre(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()
    assert [(r["track_name"], r["listen_count"]) for r in top] == [("B", 2), ("A", 1)]


def test_ties_are_broken_by_id_then_name(spark):
    songs = {f"t{i}": (f"n{9 - i}", "pop", 1) for i in range(6)}
    plays = [("u", f"t{i}", FIRST) for i in (5, 3, 1, 4, 0, 2)]
    for parts in (1, 7):
        top = kpis.compute_top_songs_per_genre(enriched_of(spark, plays, songs).repartition(parts))
        assert [r["track_id"] for r in top.orderBy("rank").collect()] == ["t0", "t1", "t2"]


def test_top_genres(enriched):
    rows = kpis.compute_top_genres_daily(enriched, listen_date="2023-11-02").orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [("2023-11-02", "01", "folk", 5), ("2023-11-02", "02", "dub", 2)]


def test_top_genres_capped_at_five(spark):
    songs = SONGS | {f"x{i}": (f"X{i}", f"genre{i}", 1) for i in range(10)}
    plays = PLAYS + [("u9", f"x{i}", FIRST) for i in range(10)]
    rows = kpis.compute_top_genres_daily(enriched_of(spark, plays, songs), listen_date="2023-11-02").collect()
    assert sorted(r["rank"] for r in rows) == ["01", "02", "03", "04", "05"]


def test_top_genres_from_daily_counts(enriched):
    daily = kpis.compute_daily_genre_kpis(enriched)
    ranked = kpis.rank_genres(daily.select("date", "genre", "listen_count"))
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, kpis.compute_top_genres_daily(enriched).collect()))


def test_empty_input(enriched):
    none = enriched.where("false")
    for frame in (
        kpis.compute_daily_genre_kpis(none),
        kpis.compute_top_songs_per_genre(none),
        kpis.compute_top_genres_daily(none),
    ):
        assert frame.count() == 0


@pytest.mark.parametrize("n", [0, 100])
def test_rank_must_fit_the_key(enriched, n):
    with pytest.raises(ValueError):
        kpis.compute_top_songs_per_genre(enriched, n=n)
