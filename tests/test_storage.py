"""Partitioned tables: pruning, reruns, cleared days, CSV scans, archive."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from spinledger.operators.kpis import compute_daily_genre_kpis, compute_top_genres_daily, compute_top_songs_per_genre
from spinledger.plans.load import NOTHING, refresh_kpis
from spinledger.schemas import Layout
from spinledger.sources import tables
from spinledger.sources.csv_tables import read_songs, read_streams, read_users
from spinledger.sources.paths import archive_input

from test_kpis import FIRST, PLAYS, SECOND, SONGS, enriched_of


def test_csv_scans(spark, tmp_path):
    (tmp_path / "streams.csv").write_text('user_id,track_id,listen_time\n1,"a ""x"", b",2024-06-25 10:00:00\n')
    (tmp_path / "songs.csv").write_text(
        'id,duration_ms,track_genre,track_id,track_name,artists\n0,200000,pop,t1,"One, two",A\n1,oops,rock,007,Two,B\n'
    )
    (tmp_path / "users.csv").write_text("user_id,user_name,user_age,user_country\n0042,Alice,25,UK\n")
    play = read_streams(spark, str(tmp_path / "streams.csv")).first()
    assert tuple(play) == ("1", 'a "x", b', dt.datetime(2024, 6, 25, 10))
    songs = read_songs(spark, str(tmp_path / "songs.csv"))
    assert dict(songs.dtypes)["duration_ms"] == "bigint"
    rows = {row["track_id"]: row for row in songs.collect()}
    assert (rows["t1"]["duration_ms"], rows["t1"]["track_name"]) == (200000, "One, two")
    assert rows["007"]["duration_ms"] is None
    user = read_users(spark, str(tmp_path / "users.csv")).first()
    assert (user["user_id"], user["user_age"]) == ("0042", 25)


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_streams(spark, str(tmp_path / "absent.csv"))


def test_write_reports_rows_and_days(spark, tmp_path):
    path = str(tmp_path / "e")
    assert tables.write_enriched(enriched_of(spark, PLAYS), path, "a") == (10, ["2023-11-02", "2023-11-05"])
    assert tables.write_enriched(enriched_of(spark, PLAYS).where("false"), path, "b") == (0, [])
    assert tables.read_enriched(spark, path).count() == 10


def test_rebalanced_write_gives_the_same_rows(spark, tmp_path):
    frame = enriched_of(spark, PLAYS)
    for rebalance in (False, True):
        tables.write_enriched(frame, str(tmp_path / str(rebalance)), "a", rebalance=rebalance)
    plain, even = (tables.read_enriched(spark, str(tmp_path / str(flag))) for flag in (False, True))
    assert sorted(plain.collect(), key=str) == sorted(even.select(plain.columns).collect(), key=str)


def test_rerun_replaces_only_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "e")
    tables.write_enriched(enriched_of(spark, PLAYS[:6]), path, "a")
    tables.write_enriched(enriched_of(spark, PLAYS[6:]), path, "b")
    tables.write_enriched(enriched_of(spark, PLAYS[:3]), path, "a")
    counts = tables.read_enriched(spark, path).groupBy("source_id").count()
    assert {row["source_id"]: row["count"] for row in counts.collect()} == {"a": 3, "b": 4}


def files_of(frame):
    return {file.split("listen_date=")[1].split("/")[0] for file in frame.inputFiles()}


def test_only_the_named_days_are_listed(spark, tmp_path):
    path = str(tmp_path / "e")
    tables.write_enriched(enriched_of(spark, PLAYS), path, "a")
    one = tables.read_enriched(spark, path, ["2023-11-05"])
    assert files_of(one) == {"2023-11-05"} and one.count() == 3
    assert "listen_date" in one.columns
    assert tables.read_enriched(spark, path, ["2023-11-05", "1999-01-01", "20231105"]).count() == 3
    assert tables.read_enriched(spark, path, ["1999-01-01"]).count() == 0


def test_filter_on_the_day_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "e")
    tables.write_enriched(enriched_of(spark, PLAYS), path, "a")
    frame = tables.read_enriched(spark, path).where(F.col("listen_date").cast("string").isin(["2023-11-05"]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cast\(listen_date", plan)


def layout_with(spark, tmp_path, plays, source_id="a"):
    layout = Layout(str(tmp_path / "root"))
    _, dates = tables.write_enriched(enriched_of(spark, plays), layout.enriched, source_id)
    return layout, dates


def test_refresh_writes_all_tables(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    assert refresh_kpis(spark, layout, dates) == {
        "daily_genre_items": 4, "top_songs_items": 5, "top_genres_items": 4, "rejected_items": 0,
    }
    daily = tables.read_kpis(spark, layout.daily_genre)
    assert dict(daily.dtypes)["date"] == "string" and daily.count() == 4
    assert tables.read_kpis(spark, layout.top_songs, ["2023-11-05"]).count() == 2
    assert files_count(spark, layout.daily_genre) == 2


def files_count(spark, path):
    return len(spark.read.parquet(path).inputFiles())


def test_refresh_is_idempotent_and_leaves_other_days(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    refresh_kpis(spark, layout, dates)
    before = sorted(map(tuple, tables.read_kpis(spark, layout.top_genres).collect()))
    refresh_kpis(spark, layout, ["2023-11-02"])
    refresh_kpis(spark, layout, dates)
    assert sorted(map(tuple, tables.read_kpis(spark, layout.top_genres).collect())) == before


def test_late_arrival_refreshes_its_days_from_all_plays(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    refresh_kpis(spark, layout, dates)
    _, late = tables.write_enriched(enriched_of(spark, [("gus", "s40", FIRST)] * 9), layout.enriched, "late")
    assert late == ["2023-11-02"]
    refresh_kpis(spark, layout, late)
    top = tables.read_kpis(spark, layout.top_genres).where("date = '2023-11-02'").orderBy("rank").collect()
    assert [(row["genre"], row["listen_count"]) for row in top] == [("opera", 9), ("folk", 5), ("dub", 2)]


def test_shrunken_day_keeps_no_stale_ranks(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    refresh_kpis(spark, layout, dates)
    tables.write_enriched(enriched_of(spark, PLAYS[:1] + PLAYS[-1:]), layout.enriched, "a")
    refresh_kpis(spark, layout, dates)
    songs = tables.read_kpis(spark, layout.top_songs, ["2023-11-02"])
    assert [row["track_id"] for row in songs.collect()] == ["s20"]


def test_emptied_day_is_cleared_everywhere(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    refresh_kpis(spark, layout, dates)
    tables.clear_partitions(spark, layout.enriched, ["listen_date=2023-11-05/source_id=a"])
    refresh_kpis(spark, layout, ["2023-11-05"])
    for table in (layout.daily_genre, layout.top_songs, layout.top_genres):
        assert {row["date"] for row in tables.read_kpis(spark, table).collect()} == {"2023-11-02"}


def test_many_days_are_cleared_by_a_fixed_number_of_jobs(spark, tmp_path):
    path, days = str(tmp_path / "table"), [f"2023-11-{day:02d}" for day in range(1, 13)]
    rows = spark.createDataFrame([(day, k) for day in days for k in range(3)], "date string, k int")
    rows.repartition(5).write.partitionBy("date").parquet(path)
    spark.sparkContext.setJobGroup("clear", "days")
    tables.clear_partitions(spark, path, [f"date={day}" for day in [*days[:10], "1999-01-01"]])
    spark.sparkContext.setJobGroup("other", "rest")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("clear")) <= 4
    left = tables.read_kpis(spark, path)
    assert left.columns == ["k", "date"] and sorted({row["date"] for row in left.collect()}) == days[10:]
    # A cleared day is still there, without rows.
    assert all(spark.read.parquet(f"{path}/date={day}").collect() == [] for day in days[:10])


def test_nothing_to_load(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    assert refresh_kpis(spark, layout, []) == NOTHING
    assert refresh_kpis(spark, layout, ["1999-01-01"]) == NOTHING


def test_rows_without_genre_are_reported_not_stored(spark, tmp_path):
    layout = Layout(str(tmp_path / "root"))
    songs = SONGS | {"s00": ("No genre", None, 1)}
    plays = PLAYS + [("ann", "s00", SECOND)] * 5
    _, dates = tables.write_enriched(enriched_of(spark, plays, songs), layout.enriched, "a")
    done = refresh_kpis(spark, layout, dates)
    assert (done["daily_genre_items"], done["top_songs_items"], done["rejected_items"]) == (4, 5, 2)
    rejected = spark.read.parquet(layout.rejected_items).collect()
    assert {(row["table"], row["reason"]) for row in rejected} == {
        ("daily_genre_kpis", "null key: genre"),
        ("top_songs_per_genre", "null key: genre"),
    }
    # The genre is no key of the ranking, so its rank stands with the name left open.
    top = tables.read_kpis(spark, layout.top_genres, ["2023-11-05"]).orderBy("rank").collect()
    assert [(row["rank"], row["genre"], row["listen_count"]) for row in top] == [("01", None, 5), ("02", "opera", 2), ("03", "folk", 1)]


def test_archive_keeps_the_key(spark, tmp_path):
    raw, archive = tmp_path / "raw", tmp_path / "archive"
    source = raw / "streams" / "2024" / "06" / "25" / "streams1.csv"
    source.parent.mkdir(parents=True)
    source.write_bytes(b"data")
    key = "streams/2024/06/25/streams1.csv"
    result = archive_input(spark, str(raw), str(archive), key)
    assert result == {"status": "archived", "from": f"{raw}/{key}", "to": f"{archive}/{key}"}
    assert (archive / key).read_bytes() == b"data" and not source.exists()
    with pytest.raises(FileNotFoundError):
        archive_input(spark, str(raw), str(archive), key)


def test_archive_needs_every_field(spark, tmp_path):
    with pytest.raises(ValueError, match="archive_root"):
        archive_input(spark, str(tmp_path), "", "streams/x.csv")


def test_archive_replaces_an_earlier_delivery(spark, tmp_path):
    for folder, content in (("raw", "new"), ("archive", "old")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text(content)
    archive_input(spark, str(tmp_path / "raw"), str(tmp_path / "archive"), "x.csv")
    assert (tmp_path / "archive" / "x.csv").read_text() == "new"
    assert not (tmp_path / "raw" / "x.csv").exists()


def unreadable(folder):
    """Overwrite stored plays in place, names and lengths kept: reading them would fail."""
    files = [file for file in folder.rglob("*.parquet") if not file.name.startswith(".")]
    for file in files:
        file.write_bytes(b"x" * file.stat().st_size)
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    return len(files)


def test_late_arrival_reads_no_plays_of_the_others(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    refresh_kpis(spark, layout, dates)
    assert unreadable(tmp_path / "root" / "enriched_streams") >= 2
    _, late = tables.write_enriched(enriched_of(spark, [("gus", "s40", FIRST), ("ann", "s40", FIRST)]), layout.enriched, "late")
    refresh_kpis(spark, layout, late)
    plain = enriched_of(spark, PLAYS + [("gus", "s40", FIRST), ("ann", "s40", FIRST)])
    for path, expected in (
        (layout.daily_genre, compute_daily_genre_kpis(plain)),
        (layout.top_songs, compute_top_songs_per_genre(plain)),
        (layout.top_genres, compute_top_genres_daily(plain)),
    ):
        stored = tables.read_kpis(spark, path).select(*expected.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect()))


def test_sums_of_a_replaced_slice_are_not_used(spark, tmp_path):
    layout, dates = layout_with(spark, tmp_path, PLAYS)
    tables.write_enriched(enriched_of(spark, [("gus", "s40", FIRST)]), layout.enriched, "b=1:2")
    refresh_kpis(spark, layout, dates)
    tables.write_enriched(enriched_of(spark, PLAYS[:2]), layout.enriched, "a")
    tables.write_enriched(enriched_of(spark, [("gus", "s40", FIRST)] * 3), layout.enriched, "007")
    refresh_kpis(spark, layout, dates)
    plain = enriched_of(spark, PLAYS[:2] + [("gus", "s40", FIRST)] * 4)
    day = "2023-11-02"
    stored = tables.read_kpis(spark, layout.daily_genre, [day]).select("genre", "listen_count", "unique_listeners", "total_listening_time_ms")
    expected = compute_daily_genre_kpis(plain).where(F.col("date") == day).select(*stored.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect()))
    versions = [folder for folder in (tmp_path / "root" / "user_partials" / f"listen_date={day}" / "source_id=a").iterdir() if folder.is_dir()]
    assert len(versions) == 1
