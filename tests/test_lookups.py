"""Reads over stored KPI tables, with the days they touch."""

import datetime as dt
import re

import pytest

from spinledger.operators import lookups
from spinledger.plans.load import refresh_kpis
from spinledger.schemas import Layout
from spinledger.sources import tables

from test_kpis import PLAYS, SECOND, enriched_of


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("kpis")))
    plays = PLAYS + [("fay", "s30", SECOND)] * 3 + [("ann", "s10", dt.date(2023, 11, 9))]
    _, dates = tables.write_enriched(enriched_of(spark, plays), layout.enriched, "a")
    refresh_kpis(spark, layout, dates)
    return layout


@pytest.fixture(scope="module")
def daily(spark, layout):
    return tables.read_kpis(spark, layout.daily_genre)


@pytest.fixture(scope="module")
def top_songs(spark, layout):
    return tables.read_kpis(spark, layout.top_songs)


@pytest.fixture(scope="module")
def top_genres(spark, layout):
    return tables.read_kpis(spark, layout.top_genres)


def partition_filters(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)


def test_genre_on_day(daily):
    found = lookups.genre_on_day(daily, "folk", "2023-11-02")
    assert [row["listen_count"] for row in found.collect()] == [5]
    assert "date" in partition_filters(found)
    assert lookups.genre_on_day(daily, "folk", "1999-01-01").count() == 0


def test_genre_history_is_in_date_order(daily):
    assert [row["date"] for row in lookups.genre_history(daily, "folk").collect()] == [
        "2023-11-02", "2023-11-05", "2023-11-09",
    ]


def test_scan_has_report_names(daily):
    assert lookups.scan_daily(daily).columns == ["Genre", "Date", "Listens", "UniqueUsers", "AvgMsPerUser"]


def test_min_listens_compares_numbers(daily):
    assert [row["genre"] for row in lookups.min_listens(daily, 3).collect()] == ["folk"]


def test_average_minutes(daily):
    rows = {row["date"]: row["avg_minutes"] for row in lookups.average_minutes(daily, "folk").collect()}
    assert rows == {"2023-11-02": 5.6, "2023-11-05": 1.0, "2023-11-09": 1.0}


def test_top_songs_on_day(top_songs):
    found = lookups.top_songs_on_day(top_songs, "folk", "2023-11-02")
    assert [(row["rank"], row["track_name"]) for row in found.collect()] == [(1, "Meadow"), (2, "Harbour")]
    assert "date" in partition_filters(found)


def test_top_songs_history(top_songs):
    keys = [row["date_rank"] for row in lookups.top_songs_history(top_songs, "folk").collect()]
    assert keys == ["2023-11-02#01", "2023-11-02#02", "2023-11-05#01", "2023-11-09#01"]


def test_top_song_of_genres(top_songs):
    found = lookups.top_song_of_genres(top_songs, ["folk", "dub", "none"], "2023-11-05").collect()
    assert sorted((row["genre"], row["track_id"]) for row in found) == [("dub", "s30"), ("folk", "s10")]


def test_top_genres_on_day(top_genres):
    assert [row["genre"] for row in lookups.top_genres_on_day(top_genres, "2023-11-02").collect()] == [
        "folk", "dub",
    ]


def test_top_genre_on_day(top_genres):
    assert [row["genre"] for row in lookups.top_genre_on_day(top_genres, "2023-11-05").collect()] == ["dub"]
