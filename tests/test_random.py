"""KPIs of random plays against plain Python, and arrivals in every order."""

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict

import pytest

from spinledger.operators import kpis
from spinledger.operators.enrich import enrich_streams
from spinledger.plans.ingest import run_batch
from spinledger.schemas import Layout
from spinledger.sources.tables import read_kpis

GENRES = ["pop", "rock", "jazz", "folk", "funk", "soul", "punk"]


def world(seed):
    rng = random.Random(seed)
    songs = [(f"t{i}", f"song {i % 17}", rng.choice(GENRES), rng.randint(1, 9) * 1000) for i in range(40)]
    users = [(f"u{i}", f"name {i}") for i in range(25)]
    plays = []
    for _ in range(3000):
        # A third of the plays is of one track by one user; some names are unknown.
        track = "t0" if rng.random() < 0.33 else f"t{rng.randint(0, 44)}"
        user = "u0" if rng.random() < 0.33 else f"u{rng.randint(0, 29)}"
        plays.append((user, track, f"2024-06-{rng.randint(20, 24)} {rng.randint(10, 23)}:00:00"))
    return plays, songs, users


def expected(plays, songs, users):
    by_track, known = {row[0]: row for row in songs}, {row[0] for row in users}
    listens, listeners, total, tracks = Counter(), defaultdict(set), Counter(), Counter()
    for user, track, time in plays:
        if track in by_track and user in known:
            _, name, genre, duration = by_track[track]
            day = time[:10]
            listens[genre, day] += 1
            listeners[genre, day].add(user)
            total[genre, day] += duration
            tracks[day, genre, track, name] += 1
    daily = {
        (*key, n, len(listeners[key]), total[key], total[key] / len(listeners[key])) for key, n in listens.items()
    }
    best, genres = set(), set()
    for day, genre in {key[:2] for key in tracks}:
        ranked = sorted((-n, key[2], key[3]) for key, n in tracks.items() if key[:2] == (day, genre))
        best |= {(genre, f"{day}#{i:02d}", track, name, -n) for i, (n, track, name) in enumerate(ranked[:3], 1)}
    for day in {key[1] for key in listens}:
        ranked = sorted((-n, key[0]) for key, n in listens.items() if key[1] == day)
        genres |= {(day, f"{i:02d}", genre, -n) for i, (n, genre) in enumerate(ranked[:5], 1)}
    return daily, best, genres


@pytest.mark.parametrize("seed", range(3))
def test_random_plays(spark, seed):
    plays, songs, users = world(seed)
    enriched = enrich_streams(
        spark.createDataFrame(plays, "user_id string, track_id string, listen_time string").repartition(5),
        spark.createDataFrame(songs, "track_id string, track_name string, track_genre string, duration_ms bigint"),
        spark.createDataFrame(users, "user_id string, user_name string"),
    )
    daily, best, genres = expected(plays, songs, users)
    got = kpis.compute_daily_genre_kpis(enriched).select(
        "genre", "date", "listen_count", "unique_listeners", "total_listening_time_ms", "avg_listening_time_per_user_ms"
    )
    assert {tuple(row) for row in got.collect()} == daily
    songs_got = kpis.compute_top_songs_per_genre(enriched)
    songs_got = songs_got.select("genre", "date_rank", "track_id", "track_name", "listen_count")
    assert {tuple(row) for row in songs_got.collect()} == best
    assert {tuple(row) for row in kpis.compute_top_genres_daily(enriched).collect()} == genres


def test_order_of_arrival_does_not_matter(spark, tmp_path):
    plays, songs, users = world(9)
    songs = spark.createDataFrame(songs, "track_id string, track_name string, track_genre string, duration_ms bigint")
    users = spark.createDataFrame(users, "user_id string, user_name string")
    for i in range(3):
        rows = "\n".join(",".join(play) for play in plays[i::3])
        (tmp_path / f"f{i}.csv").write_text(f"user_id,track_id,listen_time\n{rows}\n")
    tables = []
    for order in itertools.islice(itertools.permutations(range(3)), 0, 6, 5):
        layout = Layout(str(tmp_path / f"t{order}"))
        for i in order:
            run_batch(spark, str(tmp_path / f"f{i}.csv"), songs, users, layout)
        paths = (layout.daily_genre, layout.top_songs, layout.top_genres)
        tables.append([sorted(map(str, read_kpis(spark, path).collect())) for path in paths])
    assert tables[0] == tables[1]
    whole = expected(*[plays, *[[tuple(row) for row in frame.collect()] for frame in (songs, users)]])
    assert [len(table) for table in tables[0]] == [len(part) for part in whole]


def test_days_are_dates(spark):
    frame = spark.createDataFrame(
        [("u", "t", dt.datetime(2024, 6, 25, 1))], "user_id string, track_id string, listen_time timestamp"
    )
    songs = spark.createDataFrame([("t", "n", "g", 1)], "track_id string, track_name string, track_genre string, duration_ms int")
    users = spark.createDataFrame([("u", "n")], "user_id string, user_name string")
    assert kpis.compute_daily_genre_kpis(enrich_streams(frame, songs, users)).first()["date"] == "2024-06-25"
