"""Deliveries that repeat, break off, fail or come anew, and where their files end up."""

import gzip
import os
import time

import pytest
from test_runs import HEADER, daily, put, quarantined, songs, stream, users  # noqa: F401

from spinledger.plans import arrivals
from spinledger.plans.ingest import run_and_archive, run_batch
from spinledger.schemas import Layout
from spinledger.sources import moves
from spinledger.sources.listing import file_versions, zero_length_files
from spinledger.sources.tables import read_enriched


def names(folder):
    return sorted(str(path.relative_to(folder)) for path in folder.rglob("*") if path.is_file() and not path.name.startswith("."))


@pytest.fixture
def places(tmp_path):
    return Layout(str(tmp_path / "t")), tmp_path / "raw", tmp_path / "archive"


def test_only_empty_files_are_asked_for_by_name(spark, tmp_path, monkeypatch):
    from spinledger.sources import listing

    asked = []
    monkeypatch.setattr(listing, "empty_version", lambda spark, file: asked.append(file))
    for k in range(4):
        put(tmp_path, f"{k}.csv", "u1,t1,2024-06-25")
    (tmp_path / "none.csv").write_text("")
    file_versions(spark, str(tmp_path))
    assert [file.rsplit("/", 1)[1] for file in asked] == ["none.csv"]


def test_listing_shows_empty_files_and_opens_none(spark, tmp_path):
    put(tmp_path / "in", "a b+c.csv", "u1,t1,2024-06-25")
    (tmp_path / "in" / "deep").mkdir()
    (tmp_path / "in" / "deep" / "none.csv").write_text("")
    (tmp_path / "in" / "_hidden.csv").write_text("x")
    rows = sorted((row["file"].rsplit("/", 1)[1], row["length"]) for row in file_versions(spark, str(tmp_path / "in")).collect())
    assert rows == [("a%20b+c.csv", len(HEADER) + 18), ("none.csv", 0)]
    roots = {row["file"].removesuffix("/deep/none.csv").removesuffix("/a%20b+c.csv") for row in file_versions(spark, str(tmp_path / "in")).collect()}
    assert len(roots) == 1
    assert [row["file"][-9:] for row in zero_length_files(spark, str(tmp_path / "in")).collect()] == ["/none.csv"]


def test_two_nights_over_one_folder(spark, songs, users, places):  # noqa: F811
    layout, raw, archive = places
    for night, (name, play) in enumerate({"mon.csv": "u1,t1,2024-06-24", "tue.csv": "u1,t3,2024-06-25", "wed.csv": "u2,t1,2024-06-24"}.items()):
        put(raw, f"streams/{name}", play)
        metrics = run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
        assert metrics["rows_written"] == 1 and len(names(archive)) == night + 1
    assert names(archive) == ["streams/mon.csv", "streams/tue.csv", "streams/wed.csv"] and names(raw) == []
    assert daily(spark, layout) == [("2024-06-24", "folk", 2), ("2024-06-25", "dub", 1)]
    # One of them again, corrected: its plays and its archived text are replaced, the others stand.
    put(raw, "streams/mon.csv", "u2,t3,2024-06-24")
    run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
    assert daily(spark, layout) == [("2024-06-24", "dub", 1), ("2024-06-24", "folk", 1), ("2024-06-25", "dub", 1)]
    assert "u2,t3" in (archive / "streams" / "mon.csv").read_text() and len(names(archive)) == 3


@pytest.mark.parametrize("step", ["refresh_kpis", "store_moves", "carry_out", "write_note"])
def test_delivery_repeats_after_a_crash(spark, songs, users, places, monkeypatch, step):  # noqa: F811
    from spinledger.plans import ingest as module

    layout, raw, archive = places
    put(raw, "streams/first.csv", "u1,t1,2024-06-23")
    run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
    put(raw, "streams/a.csv", "u1,t1,2024-06-24")
    put(raw, "streams/b.csv", "u1,t3,2024-06-25")
    put(raw, "streams/bad.csv", "u1,,2024-06-25")
    with monkeypatch.context() as patch:
        patch.setattr(module if step == "refresh_kpis" else arrivals, step, lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
    put(raw, "streams/later.csv", "u2,t1,2024-06-24")
    for _ in range(2):
        run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
    assert names(archive) == ["streams/a.csv", "streams/b.csv", "streams/first.csv", "streams/later.csv"]
    assert names(raw) == ["streams/bad.csv"]
    assert daily(spark, layout) == [("2024-06-23", "folk", 1), ("2024-06-24", "folk", 2), ("2024-06-25", "dub", 1)]
    assert read_enriched(spark, layout.enriched).count() == 4


def test_moves_stop_half_way_and_go_on(spark, places):
    layout, raw, archive = places
    for name in ("a.csv", "b b.csv", "deep/c%41.csv", "gone.csv", "newer.csv"):
        put(raw, name, "u1,t1,2024-06-24")
    listed = file_versions(spark, str(raw)).collect()
    moves.store_moves(moves.planned_moves(spark.createDataFrame(listed), str(raw), str(archive)), f"{layout.moves}/x")
    archive.mkdir()
    os.rename(raw / "a.csv", archive / "a.csv")
    (raw / "gone.csv").unlink()
    put(raw, "newer.csv", "u1,t1,2024-06-24", "u1,t1,2024-06-25")
    expected = {"moved": 2, "moved before": 1, "missing": 1, "newer version": 1}
    assert moves.carry_out(spark, f"{layout.moves}/x") == expected
    assert moves.carry_out(spark, f"{layout.moves}/x") == expected
    assert names(archive) == ["a.csv", "b b.csv", "deep/c%41.csv"] and names(raw) == ["newer.csv"]


def test_file_that_arrives_during_a_run_stays(spark, songs, users, places, monkeypatch):  # noqa: F811
    layout, raw, archive = places
    put(raw, "streams/a.csv", "u1,t1,2024-06-24")
    whole = arrivals.store_moves

    def late(*args):
        put(raw, "streams/late.csv", "u1,t3,2024-06-24")
        whole(*args)

    monkeypatch.setattr(arrivals, "store_moves", late)
    run_and_archive(spark, str(raw), str(archive), "streams", songs, users, layout)
    assert names(archive) == ["streams/a.csv"] and names(raw) == ["streams/late.csv"]


def test_stream_archives_by_verdict(spark, songs, users, places, tmp_path):  # noqa: F811
    layout, raw, archive = places
    folder = raw / "streams"
    put(folder, "good.csv", "u1,t1,2024-06-25")
    put(folder, "bad.csv", "u1,,2024-06-25")
    (folder / "empty.csv").write_text("")
    put(folder, "last.csv", "u2,t1,2024-06-25")
    stream(folder, songs, users, layout, tmp_path, archive_path=str(archive))
    assert names(archive) == ["good.csv", "last.csv"] and names(folder) == ["bad.csv", "empty.csv"]
    assert [row[0] for row in quarantined(spark, layout)] == ["bad.csv", "empty.csv"]
    # Nothing waits, nothing changes.
    stream(folder, songs, users, layout, tmp_path, archive_path=str(archive))
    assert daily(spark, layout) == [("2024-06-25", "folk", 2)] and names(folder) == ["bad.csv", "empty.csv"]


def test_archived_micro_batch_comes_back(spark, songs, users, places, tmp_path):  # noqa: F811
    layout, raw, archive = places
    put(raw, "a.csv", "u1,t1,2024-06-25")
    stream(raw, songs, users, layout, tmp_path, archive_path=str(archive))
    for name in ("0", ".0.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    stream(raw, songs, users, layout, tmp_path, archive_path=str(archive))
    assert daily(spark, layout) == [("2024-06-25", "folk", 1)] and names(archive) == ["a.csv"]


def test_new_version_of_a_streamed_file_replaces_its_plays(spark, songs, users, places, tmp_path):  # noqa: F811
    layout, raw, _ = places
    put(raw, "a.csv", "u1,t1,2024-06-25", "u2,t1,2024-06-24")
    put(raw, "b.csv", "u1,t1,2024-06-25")
    stream(raw, songs, users, layout, tmp_path)
    time.sleep(0.01)
    put(raw, "a.csv", "u1,t3,2024-06-25")
    stream(raw, songs, users, layout, tmp_path)
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 1)]
    # An emptied file is a version too; it is rejected and what was stored stands.
    (raw / "b.csv").write_text("")
    stream(raw, songs, users, layout, tmp_path)
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 1)]
    assert quarantined(spark, layout) == [("b.csv", "file is empty", None)]


def broken_gzip(folder, name):
    whole = gzip.compress((HEADER + "\nu1,t1,2024-06-25\n" * 500).encode())
    (folder / name).write_bytes(whole[: len(whole) // 2])


def test_file_that_keeps_failing_is_set_aside(spark, songs, users, places, tmp_path):  # noqa: F811
    layout, raw, archive = places
    for k in range(5):
        put(raw, f"{k}.csv", "u1,t1,2024-06-25")
    broken_gzip(raw, "broken.csv.gz")
    stream(raw, songs, users, layout, tmp_path, archive_path=str(archive))
    assert daily(spark, layout) == [("2024-06-25", "folk", 5)]
    assert quarantined(spark, layout) == [("broken.csv.gz", arrivals.FAILED, None)]
    assert names(raw) == ["broken.csv.gz"] and len(names(archive)) == 5
    assert spark.read.parquet(layout.attempts).where("file like '%.gz'").count() == arrivals.MAX_ATTEMPTS
    put(raw, "next.csv", "u1,t3,2024-06-25")
    stream(raw, songs, users, layout, tmp_path, archive_path=str(archive))
    assert daily(spark, layout) == [("2024-06-25", "dub", 1), ("2024-06-25", "folk", 5)]


def test_attempts_are_counted_over_restarts(spark, songs, users, places, tmp_path, monkeypatch):  # noqa: F811
    layout, raw, _ = places
    put(raw, "fatal.csv", "u1,t1,2024-06-25")

    class Killed(BaseException):
        pass

    def die(*args, **options):
        raise Killed

    versions = file_versions(spark, str(raw))
    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "ingest", die)
        for _ in range(arrivals.MAX_ATTEMPTS):
            with pytest.raises(Killed):
                arrivals.consume(spark, versions, songs, users, layout, "s-0", streams_path=str(raw))
    arrivals.consume(spark, versions, songs, users, layout, "s-0", streams_path=str(raw))
    assert quarantined(spark, layout) == [("fatal.csv", arrivals.FAILED, None)]


def test_fault_of_all_files_stops_the_run(spark, songs, users, places):  # noqa: F811
    layout, raw, _ = places
    for name in ("a.csv", "b.csv"):
        put(raw, name, "u1,t1,2024-06-25")
    with pytest.raises(Exception, match="track_id"):
        arrivals.consume(spark, file_versions(spark, str(raw)), songs.drop("track_id"), users, layout, "s-0", streams_path=str(raw))


def test_notices_read_no_history(spark, places):
    layout, raw, _ = places
    old = f"{layout.arrivals}/day=2020-01-01/noticed=1/arrival=0"
    os.makedirs(old)
    with open(f"{old}/part.json", "w") as file:
        file.write("not to be read")
    for k in range(3):
        put(raw, f"{k}.csv", "u1,t1,2024-06-25")
    assert arrivals.notice(spark, str(raw), layout, 2) == 3
    assert arrivals.notice(spark, str(raw), layout, 2) == 0
    found = [path for path in names(__import__("pathlib").Path(layout.arrivals)) if path.endswith(".json") and "2020" not in path]
    assert len(found) == 2


def test_run_batch_of_a_folder_still_replaces(spark, songs, users, places):  # noqa: F811
    layout, raw, _ = places
    put(raw, "a.csv", "u1,t1,2024-06-25")
    run_batch(spark, str(raw), songs, users, layout)
    (raw / "a.csv").unlink()
    put(raw, "b.csv", "u1,t3,2024-06-25")
    run_batch(spark, str(raw), songs, users, layout)
    assert daily(spark, layout) == [("2024-06-25", "dub", 1)]
