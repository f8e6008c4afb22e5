"""Whole runs, in batch and as a stream."""

import pytest

from spinledger.plans.ingest import run_and_archive, run_batch, source_id_of
from spinledger.schemas import Layout
from spinledger.sources.manifest import read_dates_manifest
from spinledger.sources.tables import read_enriched, read_kpis, slice_path
from spinledger.streaming.pipeline import start_stream

HEADER = "user_id,track_id,listen_time"


@pytest.fixture(scope="module")
def songs(spark):
    return spark.createDataFrame(
        [("t1", "Harbour", "folk", 61000), ("t3", "Echo", "dub", 240000)],
        "track_id string, track_name string, track_genre string, duration_ms bigint",
    )


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([("u1", "Ann"), ("u2", "Ben")], "user_id string, user_name string")


def put(folder, name, *rows, header=HEADER):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def daily(spark, layout):
    rows = read_kpis(spark, layout.daily_genre).collect()
    return sorted((row["date"], row["genre"], row["listen_count"]) for row in rows)


def quarantined(spark, layout):
    rows = spark.read.parquet(layout.quarantine).collect()
    return sorted((row["file"].rsplit("/", 1)[1], row["reason"], row["line_no"]) for row in rows)


def test_one_file_end_to_end(spark, songs, users, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25 10:00:00", "u2,t3,2024-06-26", "u9,t1,2024-06-25")
    metrics = run_batch(spark, path, songs, users, layout, source_id="a")
    assert metrics == {
        "files_checked": 1, "files_rejected": 0, "rows_checked": 3, "quarantined": 0, "rows_written": 2,
        "dates_touched": 2, "daily_genre_items": 2, "top_songs_items": 2, "top_genres_items": 2,
        "rejected_items": 0,
    }
    assert daily(spark, layout) == [("2024-06-25", "folk", 1), ("2024-06-26", "dub", 1)]
    assert read_dates_manifest(spark, layout.manifest("a")) == ["2024-06-25", "2024-06-26"]
    stored = spark.read.parquet(layout.run_metrics).first().asDict()
    assert stored.pop("source_id") == "a" and stored == metrics


def test_bad_file_is_set_aside_and_good_ones_go_on(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "in"
    put(folder, "good.csv", "u1,t1,2024-06-25")
    put(folder, "bad.csv", "u1,t1,2024-06-25", "u1,,2024-06-25")
    put(folder, "head.csv", "u1,t1,2024-06-25", header="a,b,c")
    put(folder, "nested/only.csv")
    (folder / "empty.csv").write_text("")
    metrics = run_batch(spark, str(folder), songs, users, layout)
    assert (metrics["files_checked"], metrics["files_rejected"], metrics["rows_written"]) == (5, 4, 1)
    assert quarantined(spark, layout) == [
        ("bad.csv", "empty value in required field", 3),
        ("empty.csv", "file is empty", None),
        ("head.csv", "header mismatch", 1),
        ("only.csv", "file contains only a header, no data rows", None),
    ]


def test_row_mode_sets_single_records_aside(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "in"
    put(folder, "mixed.csv", "u1,t1,2024-06-25", "u1,,2024-06-25", "u2,t1,2024-06-25", "u1,t1,nope")
    put(folder, "head.csv", "u1,t1,2024-06-25", header="a,b,c")
    metrics = run_batch(spark, str(folder), songs, users, layout, mode="rows")
    assert (metrics["rows_written"], metrics["files_rejected"], metrics["quarantined"]) == (2, 1, 3)
    assert quarantined(spark, layout) == [
        ("head.csv", "header mismatch", 1),
        ("mixed.csv", "empty value in required field", 3),
        ("mixed.csv", "is not ISO datetime", 5),
    ]
    assert daily(spark, layout) == [("2024-06-25", "folk", 2)]


def test_source_id_must_be_a_folder_name(spark, songs, users, tmp_path):
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25")
    with pytest.raises(ValueError, match="source_id"):
        run_batch(spark, path, songs, users, Layout(str(tmp_path / "t")), source_id="a/b")


def test_unknown_mode_raises(spark, songs, users, tmp_path):
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25")
    with pytest.raises(ValueError, match="mode"):
        run_batch(spark, path, songs, users, Layout(str(tmp_path / "t")), mode="other")


def test_all_rejected_writes_no_kpis(spark, songs, users, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    metrics = run_batch(spark, put(tmp_path, "a.csv", "u1,t1,nope"), songs, users, layout)
    assert (metrics["files_rejected"], metrics["rows_written"], metrics["dates_touched"]) == (1, 0, 0)


def test_rerun_counts_once(spark, songs, users, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25", "u2,t1,2024-06-25")
    for _ in range(2):
        run_batch(spark, path, songs, users, layout)
    assert daily(spark, layout) == [("2024-06-25", "folk", 2)]
    assert spark.read.parquet(layout.run_metrics).count() == 1


def test_corrected_file_takes_back_its_old_day(spark, songs, users, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25", "u2,t1,2024-06-24")
    run_batch(spark, path, songs, users, layout)
    put(tmp_path, "a.csv", "u1,t1,2024-06-25")
    metrics = run_batch(spark, path, songs, users, layout)
    assert metrics["dates_touched"] == 2
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)]
    assert read_enriched(spark, layout.enriched).count() == 1


def test_corrected_file_leaves_the_quarantine(spark, songs, users, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    path = put(tmp_path, "a.csv", "u1,t1,nope")
    run_batch(spark, path, songs, users, layout, source_id="a")
    assert spark.read.parquet(slice_path(layout.quarantine, "a")).count() == 1
    put(tmp_path, "a.csv", "u1,t1,2024-06-25")
    run_batch(spark, path, songs, users, layout, source_id="a")
    assert spark.read.parquet(slice_path(layout.quarantine, "a")).count() == 0
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)]


def test_archive_after_success_only(spark, songs, users, tmp_path):
    layout, raw, archive = Layout(str(tmp_path / "t")), tmp_path / "raw", tmp_path / "archive"
    put(raw, "streams/good.csv", "u1,t1,2024-06-25")
    put(raw, "streams/bad.csv", "u1,t1,nope")
    for key in ("streams/good.csv", "streams/bad.csv"):
        run_and_archive(spark, str(raw), str(archive), key, songs, users, layout)
    assert (archive / "streams/good.csv").exists() and not (raw / "streams/good.csv").exists()
    assert (raw / "streams/bad.csv").exists() and not (archive / "streams/bad.csv").exists()
    assert read_dates_manifest(spark, layout.manifest(source_id_of("streams/good.csv"))) == ["2024-06-25"]


def stream(folder, songs, users, layout, tmp_path, **options):
    query = start_stream(str(folder), songs, users, layout, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return query


def test_stream_takes_files_one_by_one_and_once(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "raw" / "streams"
    put(folder, "a.csv", "u1,t1,2024-06-25")
    put(folder, "2024/b.csv", "u2,t3,2024-06-25")
    put(tmp_path / "raw" / "reference", "songs.csv", "u1,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path, max_files_per_trigger=1)
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 1)]
    assert spark.read.parquet(layout.run_metrics).count() == 2
    # A late file for the same day; the first two are not taken again.
    put(folder, "c.csv", "u2,t1,2024-06-25", "u2,t1,2024-01-01")
    stream(folder, songs, users, layout, tmp_path, max_files_per_trigger=1)
    assert daily(spark, layout) == [
        ("2024-01-01", "folk", 1), ("2024-06-25", "dub", 1), ("2024-06-25", "folk", 2),
    ]
    assert spark.read.parquet(layout.run_metrics).count() == 3


def test_stream_sets_poison_aside_and_goes_on(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "streams"
    put(folder, "bad.csv", "u1,t1,nope")
    (folder / "empty.csv").write_text("")
    put(folder, "good.csv", "u1,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path, max_files_per_trigger=10)
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)]
    assert quarantined(spark, layout) == [("bad.csv", "is not ISO datetime", 2), ("empty.csv", "file is empty", None)]


def test_stream_archives_finished_files(spark, songs, users, tmp_path):
    layout, folder, archive = Layout(str(tmp_path / "t")), tmp_path / "streams", tmp_path / "archive"
    for name in ("a.csv", "b.csv", "c.csv"):
        put(folder, name, "u1,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path, archive_path=str(archive), max_files_per_trigger=1)
    assert daily(spark, layout) == [("2024-06-25", "folk", 3)]
    archived = {path.name for path in archive.rglob("*.csv")}
    left = {path.name for path in folder.rglob("*.csv")}
    assert len(archived) >= 1 and archived | left == {"a.csv", "b.csv", "c.csv"} and not archived & left


def test_repeated_micro_batch_counts_once(spark, songs, users, tmp_path):
    """A batch that ran but was not committed comes back under its number."""
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "streams"
    put(folder, "a.csv", "u1,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path)
    commit = tmp_path / "checkpoint" / "commits" / "0"
    commit.unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    stream(folder, songs, users, layout, tmp_path)
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)]
    assert read_enriched(spark, layout.enriched).count() == 1


def test_correction_of_a_streamed_file_counts_once(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "streams"
    put(folder, "a.csv", "u1,t1,2024-06-25", "u2,t1,2024-06-24")
    put(folder, "b.csv", "u1,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path)
    path = put(folder, "a.csv", "u1,t3,2024-06-25")
    run_batch(spark, path, songs, users, layout)
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 1)]
    # The folder and then one of its files: the same identity.
    run_batch(spark, str(folder), songs, users, layout)
    run_batch(spark, path, songs, users, layout)
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 1)]
    # A correction that is rejected leaves what was stored.
    put(folder, "a.csv", "u1,t3,nope")
    run_batch(spark, str(folder / "a.csv"), songs, users, layout, source_id="other")
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 1)]


def test_crash_before_the_manifest_leaves_no_stale_day(spark, songs, users, tmp_path, monkeypatch):
    from spinledger.plans import ingest as module

    layout = Layout(str(tmp_path / "t"))
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25", "u2,t1,2024-06-24")
    with monkeypatch.context() as patch:
        patch.setattr(module, "_touched", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, path, songs, users, layout, source_id="a")
    put(tmp_path, "a.csv", "u1,t1,2024-06-25")
    run_batch(spark, path, songs, users, layout, source_id="a")
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)]
    assert read_enriched(spark, layout.enriched).count() == 1


def test_over_wide_line_rejects_its_file_only(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "in"
    put(folder, "wide.csv", "," * 30_000)
    put(folder, "good.csv", "u1,t1,2024-06-25")
    put(folder, "quoted.csv", 'u1,"' + "," * 30_000 + '",2024-06-25')
    run_batch(spark, str(folder), songs, users, layout)
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)]
    assert quarantined(spark, layout) == [("wide.csv", "column count mismatch", 2)]


def test_empty_file_is_reported_once_by_a_stream(spark, songs, users, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "streams"
    (folder).mkdir()
    (folder / "empty.csv").write_text("")
    for name in ("a.csv", "b.csv", "c.csv"):
        put(folder, name, "u1,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path, max_files_per_trigger=1)
    assert [row[1] for row in quarantined(spark, layout)] == ["file is empty"]
    metrics = spark.read.parquet(layout.run_metrics).agg({"files_checked": "sum", "files_rejected": "sum"}).first()
    assert sorted(metrics) == [1, 4]


def test_folder_run_archives_its_sound_files(spark, songs, users, tmp_path):
    layout, raw, archive = Layout(str(tmp_path / "t")), tmp_path / "raw", tmp_path / "archive"
    put(raw, "streams/good.csv", "u1,t1,2024-06-25")
    put(raw, "streams/bad.csv", "u1,t1,nope")
    run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
    assert [path.name for path in archive.rglob("*.csv")] == ["good.csv"]
    assert [path.name for path in raw.rglob("*.csv")] == ["bad.csv"]
